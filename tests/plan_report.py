"""Write PLANS.md: the executed (post-AQE) physical plan of the headline
queries at sf0.1, operators only. python tests/plan_report.py"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tickwise.session import local_session  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
NAMES = ["price_fact", "risk_mart", "correlation_mart", "asset_dim", "rolling_beta_global_denominator"]


def tidy(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+\.parquet)\]", r"\1", line)
    return line.rstrip()[:200]


def main():
    spark = local_session()
    qs = E.queries()
    out = ["# Executed plans of the headline queries", "",
           f"Generated by `tests/plan_report.py` at `{SF}` on local[8] with AQE on; attribute ids",
           "and plan ids removed, long lines cut. `ShuffleQueryStage`/`BroadcastQueryStage` are the",
           "exchanges AQE materialised; `AQEShuffleRead` shows its coalescing.", ""]
    for n in NAMES:
        df = qs[n](spark, SF)
        df._jdf.queryExecution().executedPlan().executeCollect()   # finalise AQE on this plan
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        keep = [tidy(ln) for ln in plan.splitlines()
                if re.search(r"Exchange|QueryStage|Scan|Join|Aggregate|Window|Sort |Expand|Generate|"
                             r"AQEShuffleRead|Union|TakeOrdered|Filter", ln)]
        out += [f"## {n}", "", "```", *keep, "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out) + "\n")


if __name__ == "__main__":
    main()
