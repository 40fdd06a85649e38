"""Compare every registered query with its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tests.harness import compare, duck  # noqa: E402
from tickwise.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = local_session()
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for n in (names or list(qs)):
    t = time.time()
    if n not in sqls:
        rows = qs[n](spark, sf).count()
        print(f"-- {n}: rows-only {rows} ({time.time()-t:.1f}s)")
        continue
    try:
        r = compare(spark, con, sf, n, qs[n], sqls[n])
    except Exception as e:  # report and continue
        r = {"name": n, "ok": False, "why": repr(e)[:600]}
    bad += not r["ok"]
    print(("OK " if r["ok"] else "BAD"), json.dumps(r, default=str)[:1500], f"({time.time()-t:.1f}s)")
print("failures:", bad)
