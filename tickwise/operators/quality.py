"""Data-quality checks (T1-T4 declarative tests, X1-X11 expectations).

Checks are data (spec tuples). The evaluator folds every row-level check on
one table into a single ``agg`` (one scan, one output row, unpivoted with
``inline``); only uniqueness and accepted-value checks add a shuffle, and
those are partially aggregated by value before it. Results are one row per
check.

Semantics follow the tools the reference uses: a declarative test fails
by its failing-row count (for ``unique`` and ``accepted_values`` that is
the number of offending *values*); NULL never fails ``expression``,
``unique`` or ``accepted_values``; an expectation passes when the share of
non-NULL rows that meet it is at least ``mostly``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import rnd


@dataclass(frozen=True)
class Test:
    model: str
    kind: str                 # unique | not_null | accepted_values | expression
    column: str
    values: tuple = ()
    expr: str = ""            # appended to the column: '>= 0', 'between -1 and 1'
    where: str | None = None

    @property
    def test_id(self) -> str:
        tag = {"expression": "expr"}.get(self.kind, self.kind)
        return f"{tag}:{self.model}.{self.column}"


KINDS = ["ACAO", "FII", "ETF", "INDICE"]
SERIES = ["selic_meta", "selic_diaria", "usd_brl", "eur_brl", "igpm", "cdi", "pib_mensal", "ipca"]
GROUPS = ["juros", "inflacao", "cambio", "atividade", "outro"]
PROFILES = ["baixo", "medio", "alto"]


def _u(m, c):
    return Test(m, "unique", c)


def _nn(m, c):
    return Test(m, "not_null", c)


def _nn_where(c):
    return f"{c} is not null"


# The 57 declarative tests of the reference, on the renamed models.
DATA_TESTS: list[Test] = [
    # raw sources
    _u("raw_bars", "id"), _nn("raw_bars", "id"), _nn("raw_bars", "symbol"),
    _nn("raw_bars", "trade_date"), _nn("raw_bars", "close"), _nn("raw_bars", "adj_close"),
    _u("raw_macro", "id"), _nn("raw_macro", "id"), _nn("raw_macro", "obs_date"),
    _nn("raw_macro", "series"), _nn("raw_macro", "value"),
    _u("raw_assets", "id"), _nn("raw_assets", "id"), _u("raw_assets", "symbol"),
    _nn("raw_assets", "symbol"), _nn("raw_assets", "kind"),
    Test("raw_assets", "accepted_values", "kind", tuple(KINDS)),
    # staging
    _nn("stg_bars", "symbol"), _nn("stg_bars", "trade_date"), _nn("stg_bars", "adj_close"),
    Test("stg_bars", "expression", "adj_close", expr=">= 0"),
    Test("stg_bars", "expression", "high", expr=">= low", where="high is not null and low is not null"),
    _nn("stg_macro", "obs_date"), _nn("stg_macro", "series"),
    Test("stg_macro", "accepted_values", "series", tuple(SERIES)),
    _nn("stg_macro", "value"),
    Test("stg_macro", "accepted_values", "series_group", tuple(GROUPS)),
    _u("stg_assets", "symbol"), _nn("stg_assets", "symbol"),
    Test("stg_assets", "accepted_values", "kind", tuple(KINDS)),
    # intermediate
    _nn("daily_returns", "symbol"), _nn("daily_returns", "trade_date"),
    Test("daily_returns", "expression", "simple_return", expr="between -0.9 and 10",
         where=_nn_where("simple_return")),
    _nn("macro_wide", "obs_date"),
    # marts
    _u("price_fact", "id"), _nn("price_fact", "id"), _nn("price_fact", "symbol"),
    _nn("price_fact", "trade_date"), _nn("price_fact", "adj_close"),
    Test("price_fact", "expression", "adj_close", expr="> 0"),
    Test("price_fact", "expression", "simple_return", expr="between -0.9 and 5.0",
         where=_nn_where("simple_return")),
    Test("price_fact", "expression", "ann_vol", expr=">= 0", where=_nn_where("ann_vol")),
    _u("asset_dim", "id"), _nn("asset_dim", "id"), _u("asset_dim", "symbol"),
    _nn("asset_dim", "symbol"),
    Test("asset_dim", "accepted_values", "kind", tuple(KINDS)),
    Test("asset_dim", "accepted_values", "risk_profile", tuple(PROFILES)),
    _u("risk_mart", "id"), _nn("risk_mart", "id"), _nn("risk_mart", "symbol"),
    _nn("risk_mart", "year"),
    Test("risk_mart", "expression", "win_rate_pct", expr="between 0 and 100",
         where=_nn_where("win_rate_pct")),
    Test("risk_mart", "expression", "max_drawdown_pct", expr="<= 0",
         where=_nn_where("max_drawdown_pct")),
    _u("correlation_mart", "id"), _nn("correlation_mart", "id"),
    Test("correlation_mart", "expression", "correlation", expr="between -1 and 1",
         where=_nn_where("correlation")),
]


def _row_count_expr(t: Test) -> Column:
    if t.kind == "not_null":
        return F.count_if(F.col(t.column).isNull())
    cond = f"NOT ({t.column} {t.expr})"
    if t.where:
        cond = f"({t.where}) AND {cond}"
    return F.expr(f"count_if({cond})")


def _tested_value(t: Test) -> Column:
    """The value a unique or accepted-values test counts, as text; NULL if none."""
    c = F.col(t.column)
    return (c if t.kind == "unique" else F.when(~c.isin(*t.values), c)).cast("string")


def _unpivot(counts: DataFrame, ts: list[Test]) -> DataFrame:
    """One row per test from one row with the failure counts c0, c1, ..."""
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(t.test_id).alias("test_id"), F.lit(t.model).alias("model"),
                 F.lit(t.kind).alias("kind"), F.lit(t.column).alias("column_name"),
                 F.col(f"c{i}").cast("long").alias("failures")) for i, t in enumerate(ts)])))


def run_tests(tables: dict[str, DataFrame], tests: list[Test]) -> DataFrame:
    """Evaluate declarative tests; one row per test with its failure count.

    A table's row tests are one aggregate; its unique and accepted-values
    tests together are one partially aggregated shuffle by (test, value)."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Test]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    for model, ts in by_model.items():
        df = tables[model]
        row_tests = [t for t in ts if t.kind in ("not_null", "expression")]
        if row_tests:
            parts.append(_unpivot(df.agg(*[_row_count_expr(t).alias(f"c{i}")
                                           for i, t in enumerate(row_tests)]), row_tests))
        value_tests = [t for t in ts if t.kind in ("unique", "accepted_values")]
        if value_tests:
            items = F.array(*[F.struct(F.lit(i).alias("i"), _tested_value(t).alias("v"))
                              for i, t in enumerate(value_tests)])
            seen = (df.select(F.inline(items)).where(F.col("v").isNotNull())
                      .groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
            least = {"unique": 2, "accepted_values": 1}
            parts.append(_unpivot(seen.agg(*[
                F.count_if((F.col("i") == i) & (F.col("n") >= least[t.kind])).alias(f"c{i}")
                for i, t in enumerate(value_tests)]), value_tests))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("failures") == 0)


# ---------------------------------------------------------------------------
# Expectations


@dataclass(frozen=True)
class Expectation:
    suite: str
    etype: str
    column: str | None = None
    kwargs: dict = field(default_factory=dict, hash=False, compare=False)

    def kw(self, k, default=None):
        return self.kwargs.get(k, default)


def _e(suite, etype, column=None, **kw):
    return Expectation(suite, etype, column, kw)


BAR_SUITE = "suite_bars"
MACRO_SUITE = "suite_macro"
# The two expectation suites of the reference, on renamed columns.
EXPECTATIONS: list[Expectation] = [
    _e(BAR_SUITE, "expect_table_row_count_to_be_between", min_value=1000, max_value=None),
    _e(BAR_SUITE, "expect_column_values_to_not_be_null", "symbol"),
    _e(BAR_SUITE, "expect_column_values_to_not_be_null", "trade_date"),
    _e(BAR_SUITE, "expect_column_values_to_not_be_null", "adj_close"),
    _e(BAR_SUITE, "expect_column_values_to_be_between", "adj_close",
       min_value=0.01, max_value=100000, mostly=0.99),
    _e(BAR_SUITE, "expect_column_values_to_be_between", "volume",
       min_value=0, max_value=None, mostly=0.95),
    _e(BAR_SUITE, "expect_column_pair_values_a_to_be_greater_than_b", None,
       column_A="high", column_B="low", or_equal=True, mostly=0.999),
    _e(BAR_SUITE, "expect_column_values_to_be_in_set", "source",
       value_set=["yahoo_finance", "b3", "manual"]),
    _e(BAR_SUITE, "expect_compound_columns_to_be_unique", None,
       column_list=["symbol", "trade_date"]),
    _e(BAR_SUITE, "expect_column_values_to_match_regex", "symbol",
       regex="^[A-Z0-9^.]{3,10}$", mostly=0.99),
    _e(BAR_SUITE, "expect_column_values_to_be_dateutil_parseable", "trade_date"),
    _e(BAR_SUITE, "expect_column_stdev_to_be_between", "adj_close", min_value=0.01, max_value=None),
    _e(MACRO_SUITE, "expect_table_row_count_to_be_between", min_value=100, max_value=None),
    _e(MACRO_SUITE, "expect_column_values_to_not_be_null", "obs_date"),
    _e(MACRO_SUITE, "expect_column_values_to_not_be_null", "series"),
    _e(MACRO_SUITE, "expect_column_values_to_not_be_null", "value"),
    _e(MACRO_SUITE, "expect_column_values_to_be_in_set", "series", value_set=SERIES),
    _e(MACRO_SUITE, "expect_column_values_to_be_between", "value",
       min_value=-50, max_value=10000, mostly=0.999),
    _e(MACRO_SUITE, "expect_compound_columns_to_be_unique", None,
       column_list=["obs_date", "series"]),
    _e(MACRO_SUITE, "expect_column_values_to_be_in_set", "source",
       value_set=["bcb", "ibge", "manual"]),
    _e(MACRO_SUITE, "expect_column_values_to_be_between", "value",
       min_value=-5, max_value=100,
       row_condition="series in ('ipca','igpm','selic_meta','selic_diaria','cdi')", mostly=0.999),
]


def _bounds(c: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _mostly_ok(elements: Column, unexpected: Column, mostly) -> Column:
    m = 1.0 if mostly is None else float(mostly)
    e = elements.cast("double")
    return (elements == 0) | (((e - unexpected.cast("double")) / F.when(e > 0, e)) >= F.lit(m))


def _row_level(e: Expectation, dtypes: dict[str, str]):
    """(element_count, unexpected_count, observed) aggregate columns or None."""
    t = e.etype
    cond = F.expr(e.kw("row_condition")) if e.kw("row_condition") else F.lit(True)
    c = F.col(e.column) if e.column else None
    if t == "expect_table_row_count_to_be_between":
        n = F.count(F.lit(1))
        return n, F.lit(None).cast("long"), n.cast("double")
    if t == "expect_column_values_to_not_be_null":
        return F.count_if(cond), F.count_if(cond & c.isNull()), F.lit(None).cast("double")
    if t == "expect_column_values_to_be_between":
        nn = cond & c.isNotNull()
        return (F.count_if(nn), F.count_if(nn & ~_bounds(c, e.kw("min_value"), e.kw("max_value"))),
                F.lit(None).cast("double"))
    if t == "expect_column_values_to_be_in_set":
        nn = cond & c.isNotNull()
        return F.count_if(nn), F.count_if(nn & ~c.isin(*e.kw("value_set"))), F.lit(None).cast("double")
    if t == "expect_column_values_to_match_regex":
        nn = cond & c.isNotNull()
        return (F.count_if(nn), F.count_if(nn & ~c.rlike(e.kw("regex"))),
                F.lit(None).cast("double"))
    if t == "expect_column_values_to_be_dateutil_parseable":
        nn = cond & c.isNotNull()
        if dtypes.get(e.column) in ("date", "timestamp", "timestamp_ntz"):
            bad = F.lit(False)
        else:
            bad = F.try_to_timestamp(c.cast("string")).isNull()
        return F.count_if(nn), F.count_if(nn & bad), F.lit(None).cast("double")
    if t == "expect_column_pair_values_a_to_be_greater_than_b":
        a, b = F.col(e.kw("column_A")), F.col(e.kw("column_B"))
        keep = cond & ~(a.isNull() & b.isNull())   # ignore_row_if both missing
        ok = (a >= b) if e.kw("or_equal") else (a > b)
        return F.count_if(keep), F.count_if(keep & ~F.coalesce(ok, F.lit(False))), \
            F.lit(None).cast("double")
    if t == "expect_column_stdev_to_be_between":
        return F.count(c), F.lit(None).cast("long"), rnd(F.stddev_samp(c), 6)
    return None


def _success(e: Expectation, el: Column, un: Column, obs: Column) -> Column:
    t = e.etype
    if t in ("expect_table_row_count_to_be_between", "expect_column_stdev_to_be_between"):
        return F.coalesce(_bounds(obs, e.kw("min_value"), e.kw("max_value")), F.lit(False))
    return _mostly_ok(el, un, e.kw("mostly"))


def _exp_row(e: Expectation, idx: int, el, un, obs) -> Column:
    return F.struct(F.lit(e.suite).alias("suite"), F.lit(idx).alias("expectation_idx"),
                    F.lit(e.etype).alias("expectation_type"),
                    F.lit(e.column or ",".join(e.kw("column_list") or
                                               [e.kw("column_A") or "", e.kw("column_B") or ""]))
                    .alias("column_name"),
                    el.cast("long").alias("element_count"),
                    un.cast("long").alias("unexpected_count"),
                    obs.cast("double").alias("observed_value"),
                    _success(e, el, un, obs).alias("success"))


def run_expectations(tables: dict[str, DataFrame], exps: list[Expectation]) -> DataFrame:
    """Evaluate expectations, one row per expectation (index within its suite)."""
    parts = []
    index = {id(e): i for i, e in enumerate(EXPECTATIONS)}
    by_suite: dict[str, list[Expectation]] = {}
    for e in exps:
        by_suite.setdefault(e.suite, []).append(e)
    for suite, es in by_suite.items():
        df = tables[suite]
        dtypes = dict(df.dtypes)
        row_es = [(e, _row_level(e, dtypes)) for e in es]
        row_es = [(e, r) for e, r in row_es if r is not None]
        if row_es:
            aggs = []
            for i, (e, (el, un, obs)) in enumerate(row_es):
                aggs += [el.alias(f"e{i}"), un.alias(f"u{i}"), obs.alias(f"o{i}")]
            a = df.agg(*aggs)
            items = [_exp_row(e, index.get(id(e), -1), F.col(f"e{i}"), F.col(f"u{i}"), F.col(f"o{i}"))
                     for i, (e, _) in enumerate(row_es)]
            parts.append(a.select(F.inline(F.array(*items))))
        for e in es:
            if e.etype == "expect_compound_columns_to_be_unique":
                cols = e.kw("column_list")
                keep = ~reduce(lambda x, y: x & y, [F.col(c).isNull() for c in cols])
                g = df.where(keep).groupBy(*cols).count()
                a = g.agg(F.sum("count").alias("el"),
                          F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0))
                          .alias("un"))
                parts.append(a.select(F.inline(F.array(_exp_row(
                    e, index.get(id(e), -1), F.coalesce(F.col("el"), F.lit(0)), F.col("un"),
                    F.lit(None).cast("double"))))))
    return reduce(DataFrame.unionByName, parts)
