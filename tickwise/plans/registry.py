"""Every query of the inventory: a Spark plan and its DuckDB oracle SQL.

``QUERIES[name] = (fn(models) -> DataFrame, final SQL or None)``. Every
query reads the given tables (through the adapter) over their whole
extent; an oracle of None marks the four jobs with side effects, checked on
rows only here and by asserting tests in ``tests/test_jobs.py``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import surrogate_key
from tickwise.operators import assets as A, macro as Mc, pairs as P
from tickwise.operators import reports as Rp, risk as R, segments as Sg, series as S
from tickwise.plans import oracle as O
from tickwise.plans.context import Models
from tickwise.session import stored

QUERIES: dict[str, tuple[Callable[[Models], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _dbl(df: DataFrame) -> DataFrame:
    """Decimal columns to double for comparison (values have <= 6 places)."""
    return df.select([F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                      for c, t in df.dtypes])


PRICES = "CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, " \
         "CAST(close AS DOUBLE) AS close, CAST(adj_close AS DOUBLE) AS adj_close"

# ---- staging -----------------------------------------------------------------


@register("stg_bars", f"SELECT symbol, trade_date, {PRICES}, volume, source FROM stg_bars")
def q_stg_bars(m: Models):
    return _dbl(m.stg_bars)


@register("stg_macro", "SELECT obs_date, series, CAST(value AS DOUBLE) AS value, unit, source, "
                       "frequency, series_group FROM stg_macro")
def q_stg_macro(m: Models):
    return _dbl(m.stg_macro)


@register("stg_assets", "SELECT * FROM stg_assets")
def q_stg_assets(m: Models):
    return m.stg_assets


# ---- returns -----------------------------------------------------------------


@register("lag_price", "SELECT symbol, trade_date, CAST(adj_close AS DOUBLE) AS adj_close, "
                       "CAST(prev_adj_close AS DOUBLE) AS prev_adj_close FROM lagged")
def q_lag_price(m: Models):
    return _dbl(S.with_lag(m.stg_bars).select("symbol", "trade_date", "adj_close", "prev_adj_close"))


@register("session_gap_days", "SELECT symbol, trade_date, days_since_prev FROM lagged")
def q_gap_days(m: Models):
    return S.with_lag(m.stg_bars).select("symbol", "trade_date", "days_since_prev")


@register("simple_return", "SELECT symbol, trade_date, simple_return FROM returns")
def q_simple_return(m: Models):
    return m.returns.select("symbol", "trade_date", "simple_return")


@register("log_return", "SELECT symbol, trade_date, log_return FROM returns")
def q_log_return(m: Models):
    return m.returns.select("symbol", "trade_date", "log_return")


@register("daily_returns", "SELECT symbol, trade_date, CAST(adj_close AS DOUBLE) AS adj_close, "
                           "CAST(prev_adj_close AS DOUBLE) AS prev_adj_close, volume, "
                           "days_since_prev, simple_return, log_return FROM returns")
def q_daily_returns(m: Models):
    return _dbl(m.returns)


# ---- macro -----------------------------------------------------------------------

_DC = [o for _, o in Mc.DAILY_PIVOT]
_MC = [o for _, o in Mc.MONTHLY_PIVOT]


def _cast_list(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


@register("macro_date_spine", "SELECT obs_date FROM spine")
def q_spine(m: Models):
    return Mc.date_spine(m.stg_macro)


@register("macro_pivot_daily", f"SELECT obs_date, {_cast_list(_DC)} FROM pivot_daily")
def q_pivot_daily(m: Models):
    return _dbl(Mc.pivot_daily(m.stg_macro))


@register("macro_pivot_monthly", f"SELECT month, {_cast_list(_MC)} FROM pivot_monthly")
def q_pivot_monthly(m: Models):
    return _dbl(Mc.pivot_monthly(m.stg_macro))


@register("macro_wide", f"SELECT obs_date, {_cast_list(_DC + _MC + ['cdi_mtd_sum'])} FROM macro_wide")
def q_macro_wide(m: Models):
    return _dbl(m.macro_wide)


@register("cdi_mtd_sum", "SELECT obs_date, CAST(cdi_daily AS DOUBLE) AS cdi_daily, "
                         "CAST(cdi_mtd_sum AS DOUBLE) AS cdi_mtd_sum FROM macro_wide")
def q_cdi_mtd(m: Models):
    return _dbl(m.macro_wide.select("obs_date", "cdi_daily", "cdi_mtd_sum"))


@register("macro_ffill", f"""
  SELECT s.obs_date, {', '.join(f'CAST(f.{c} AS DOUBLE) AS {c}' for c in _MC)}
  FROM spine s LEFT JOIN (
    SELECT month, {', '.join(f'last_value({c} IGNORE NULLS) OVER (ORDER BY month {O.RUN}) AS {c}' for c in _MC)}
    FROM (SELECT DISTINCT CAST(date_trunc('month', obs_date) AS DATE) AS month FROM spine) mm
    LEFT JOIN pivot_monthly USING (month)) f
  ON f.month = CAST(date_trunc('month', s.obs_date) AS DATE)""")
def q_ffill(m: Models):
    return _dbl(Mc.macro_ffill(m.stg_macro))


# ---- fact --------------------------------------------------------------------------


@register("benchmark_series", "SELECT trade_date, bench_return, bench_level FROM bench")
def q_bench(m: Models):
    return S.benchmark_series(m.returns, m.params)


@register("rolling_volatility", "SELECT symbol, trade_date, ann_vol FROM fact_win")
def q_vol(m: Models):
    return m.returns.select("symbol", "trade_date", S.rolling_volatility_col(m.params).alias("ann_vol"))


@register("rolling_mean_return", "SELECT symbol, trade_date, mean_return_window FROM fact_win")
def q_mean(m: Models):
    return m.returns.select("symbol", "trade_date",
                            S.rolling_mean_col(m.params).alias("mean_return_window"))


@register("rolling_beta", "SELECT symbol, trade_date, beta FROM fact_win "
                          f"WHERE has_bench AND symbol <> {O.q(O.BENCH)}")
def q_beta(m: Models):
    x = S.with_rolling_beta(S.with_benchmark(m.returns, m.params), m.params)
    b = x.select("symbol", "trade_date", "has_bench", "beta")
    return b.where(F.col("has_bench") & (F.col("symbol") != m.params.benchmark)).drop("has_bench")


@register("cumulative_return", "SELECT symbol, trade_date, cum_return FROM fact_win")
def q_cum(m: Models):
    return m.returns.select("symbol", "trade_date", S.cumulative_return_col().alias("cum_return"))


@register("ytd_return", "SELECT symbol, trade_date, ytd_return FROM fact_win")
def q_ytd(m: Models):
    return m.returns.select("symbol", "trade_date", S.ytd_return_col().alias("ytd_return"))


@register("real_return", "SELECT symbol, trade_date, ipca_monthly, real_return FROM price_fact")
def q_real(m: Models):
    return m.fact.select("symbol", "trade_date", "ipca_monthly", "real_return")


@register("excess_return", "SELECT symbol, trade_date, cdi_daily, excess_return FROM price_fact")
def q_excess(m: Models):
    return m.fact.select("symbol", "trade_date", "cdi_daily", "excess_return")


@register("surrogate_key", "SELECT id, symbol, trade_date FROM price_fact")
def q_key(m: Models):
    return m.returns.select(surrogate_key("symbol", "trade_date").alias("id"), "symbol", "trade_date")


@register("price_fact", "SELECT * FROM price_fact")
def q_fact(m: Models):
    return m.fact


# ---- asset dimension -------------------------------------------------------------------


@register("asset_stats", "SELECT symbol, sessions, first_date, last_date, avg_price, min_price, "
                         "max_price, avg_daily_volume FROM asset_agg")
def q_asset_stats(m: Models):
    return A.asset_stats(m.fact)


@register("asset_zero_mean_variance", f"""
  SELECT symbol, {O.R('sum(simple_return * simple_return) / nullif(count(simple_return) - 1, 0)', 8)}
    AS zero_mean_variance FROM price_fact GROUP BY symbol""")
def q_zmv(m: Models):
    return A.zero_mean_variance(m.fact)


@register("latest_snapshot", "SELECT symbol, snap.* FROM asset_agg")
def q_snapshot(m: Models):
    return A.latest_snapshot(m.fact)


@register("risk_profile", "SELECT symbol, current_vol, risk_profile FROM asset_dim")
def q_risk_profile(m: Models):
    return m.asset_dim.select("symbol", "current_vol", "risk_profile")


@register("asset_dim", "SELECT * FROM asset_dim")
def q_asset_dim(m: Models):
    return m.asset_dim


# ---- risk mart --------------------------------------------------------------------------------


@register("running_peak", "SELECT symbol, trade_date, running_peak FROM fact_dd")
def q_peak(m: Models):
    f = m.fact.where(F.col("symbol") != m.params.benchmark)
    return f.select("symbol", "trade_date", S.running_peak_col().cast("double").alias("running_peak"))


@register("drawdown", "SELECT symbol, trade_date, drawdown FROM fact_dd")
def q_drawdown(m: Models):
    f = R.with_drawdown(m.fact.where(F.col("symbol") != m.params.benchmark))
    return f.select("symbol", "trade_date", "drawdown")


@register("segmented_series", f"""
  SELECT symbol, trade_date, ann_vol, mean_return_window, cum_return, ytd_return, beta, running_peak,
    {O.R('(CAST(adj_close AS DOUBLE) - running_peak) / nullif(running_peak, 0)', 6)} AS drawdown
  FROM (SELECT *, CAST(max(adj_close) OVER (PARTITION BY symbol ORDER BY trade_date
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_peak FROM fact_win) t""")
def q_segmented_series(m: Models):
    """D2-D4, D8-D9, F1, F2 over segments of a few months, as for histories
    that no task can hold."""
    bars = stored(m.stg_bars.select("symbol", "trade_date", "adj_close", "volume"), "segment_bars")
    return Sg.segmented_series(bars, m.params.with_(segment_rows=200))


@register("downside_return", f"SELECT symbol, trade_date, {O._NEG} AS downside_return FROM fact_nb")
def q_downside(m: Models):
    f = m.fact.where(F.col("symbol") != m.params.benchmark)
    return f.select("symbol", "trade_date", R.downside_col().alias("downside_return"))


def _annual(*names):
    def fn(m: Models):
        return R.annual_metrics(m.fact, m.params, list(names))
    return fn


_ANNUAL_KEYS = {
    "max_drawdown": ["max_drawdown"],
    "annual_return": ["annual_return", "annual_return_comp"],
    "annual_volatility": ["annual_vol"],
    "annual_mean_return": ["annual_mean_return"],
    "sharpe": ["sharpe"],
    "value_at_risk": ["var_95", "var_99"],
    "up_down_days": ["up_days", "down_days"],
    "mean_beta": ["mean_beta"],
    "sortino": ["sortino"],
}
for _k, _cols in _ANNUAL_KEYS.items():
    register(_k, f"SELECT symbol, year, {', '.join(_cols)} FROM annual")(_annual(*_cols))


@register("win_rate", "SELECT symbol, year, sessions, up_days, win_rate_pct FROM risk_mart")
def q_win_rate(m: Models):
    return m.risk_mart.select("symbol", "year", "sessions", "up_days", "win_rate_pct")


@register("sharpe_class", "SELECT symbol, year, sharpe, sharpe_class FROM risk_mart")
def q_sharpe_class(m: Models):
    return m.risk_mart.select("symbol", "year", "sharpe", "sharpe_class")


@register("risk_mart", "SELECT * FROM risk_mart")
def q_risk_mart(m: Models):
    return m.risk_mart


# ---- correlation mart ------------------------------------------------------------------------


@register("return_years", "SELECT DISTINCT CAST(year(trade_date) AS INTEGER) AS year FROM pair_ret")
def q_years(m: Models):
    return P.return_years(m.fact, m.params)


@register("asset_pairs", "SELECT symbol_a, symbol_b, year FROM pair_mom")
def q_pairs(m: Models):
    return P.asset_pairs(m.fact, m.params)


@register("pairwise_correlation", "SELECT * FROM pair_corr")
def q_pair_corr(m: Models):
    return P.pairwise_correlation(m.fact, m.params)


@register("correlation_class", "SELECT symbol_a, symbol_b, year, correlation, corr_class "
                               "FROM correlation_mart")
def q_corr_class(m: Models):
    return m.correlation_mart.select("symbol_a", "symbol_b", "year", "correlation", "corr_class")


@register("diversification_class", "SELECT symbol_a, symbol_b, year, correlation, diversification "
                                   "FROM correlation_mart")
def q_div_class(m: Models):
    return m.correlation_mart.select("symbol_a", "symbol_b", "year", "correlation",
                                     "diversification")


@register("correlation_mart", "SELECT * FROM correlation_mart")
def q_corr_mart(m: Models):
    return m.correlation_mart


@register("rolling_beta_global_denominator", "SELECT * FROM beta_global")
def q_beta_global(m: Models):
    return S.rolling_beta_global_denominator(m.returns, m.params)


# ---- macros and reports ------------------------------------------------------------------
PERIOD = ("1996-03-15", "1999-06-30")


@register("period_return", f"""
  SELECT symbol, {O.R('exp(sum(log_return)) - 1', 8)} AS period_return FROM price_fact
  WHERE trade_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' AND log_return IS NOT NULL
  GROUP BY symbol""")
def q_period_return(m: Models):
    return Rp.period_return(m.fact, *PERIOD)


@register("session_gaps", """
  SELECT * FROM (
    SELECT symbol, trade_date AS curr_date, lag(trade_date) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_date,
      CAST(datediff('day', lag(trade_date) OVER (PARTITION BY symbol ORDER BY trade_date), trade_date) AS INTEGER) AS gap_days
    FROM stg_bars) t
  WHERE gap_days > 10 AND dayofweek(prev_date) NOT IN (5, 6)""")
def q_session_gaps(m: Models):
    return Rp.session_gaps(m.stg_bars)


@register("asset_overview", "SELECT symbol, name, sector, kind, last_price, ytd_return, current_vol, "
                            "current_beta, risk_profile FROM asset_dim")
def q_overview(m: Models):
    return Rp.asset_overview(m.asset_dim)


@register("base100_prices", f"""
  SELECT f.symbol, f.trade_date, f.adj_close, {O.R('f.adj_close / b.base_price * 100', 6)} AS base100
  FROM fact_nb f LEFT JOIN (
    SELECT symbol, adj_close AS base_price FROM fact_nb
    WHERE trade_date = (SELECT min(trade_date) FROM fact_nb)) b ON b.symbol = f.symbol""")
def q_base100(m: Models):
    # The fact is read three times (first date, base prices, rows): use it
    # stored, as the report reads the published table.
    return Rp.base100_prices(m.stored().fact, m.params)


@register("correlation_matrix", """
  WITH y AS (SELECT max(year) AS year FROM correlation_mart),
  m AS (SELECT c.symbol_a, c.symbol_b, c.year, c.correlation FROM correlation_mart c JOIN y USING (year)),
  s AS (SELECT DISTINCT symbol_a AS s, year FROM m UNION SELECT DISTINCT symbol_b, year FROM m),
  b AS (SELECT symbol_a, symbol_b, correlation FROM m UNION ALL SELECT symbol_b, symbol_a, correlation FROM m)
  SELECT sa.year, sa.s AS symbol_a, sb.s AS symbol_b,
    CASE WHEN sa.s = sb.s THEN 1.0 WHEN b.symbol_a IS NOT NULL THEN b.correlation ELSE 0.0 END AS correlation
  FROM s sa JOIN s sb ON sa.year = sb.year
  LEFT JOIN b ON b.symbol_a = sa.s AND b.symbol_b = sb.s""")
def q_corr_matrix(m: Models):
    return P.correlation_matrix(m.stored().correlation_mart, params=m.params)


@register("top_sharpe", """
  SELECT symbol, year, annual_return_pct, volatility_pct, sharpe, max_drawdown_pct, win_rate_pct,
    var_95_pct, CASE WHEN sharpe IS NOT NULL THEN greatest(sharpe, 0.0) * 200 + 50 END AS marker_size
  FROM risk_mart WHERE year = (SELECT max(year) FROM risk_mart)
  ORDER BY sharpe DESC NULLS FIRST, symbol LIMIT 5""")
def q_top_sharpe(m: Models):
    return Rp.top_sharpe(m.stored().risk_mart)


@register("macro_history", """
  SELECT obs_date, series, CAST(value AS DOUBLE) AS value FROM stg_macro
  WHERE series IN ('selic_meta', 'ipca', 'usd_brl', 'cdi') AND frequency IN ('diario', 'mensal')""")
def q_macro_history(m: Models):
    return Rp.macro_history(m.stg_macro)


# ---- data quality --------------------------------------------------------------------------------
from tickwise.operators import quality as Qy  # noqa: E402


def _tests(kind: str | None):
    ts = [t for t in Qy.DATA_TESTS if kind is None or t.kind == kind]

    def fn(m: Models):
        models = {t.model for t in ts}
        tables = (m.stored() if len(models) > 1 else m).test_tables()
        return Qy.run_tests({k: tables[k] for k in models}, ts)
    return ts, fn


for _key, _kind in [("check_unique", "unique"), ("check_not_null", "not_null"),
                    ("check_accepted_values", "accepted_values"),
                    ("check_expression", "expression"), ("data_tests", None)]:
    _ts, _fn = _tests(_kind)
    register(_key, O.tests_sql(_ts))(_fn)


def _exps(etypes: tuple[str, ...] | None, row_condition: bool | None = None):
    es = [e for e in Qy.EXPECTATIONS if (etypes is None or e.etype in etypes)
          and (row_condition is None or bool(e.kw("row_condition")) == row_condition)]

    compound = "expect_compound_columns_to_be_unique"
    # a suite mixing row-level checks with a uniqueness check reads its table
    # twice; such runs use the inputs stored once
    twice = any(e.etype == compound for e in es) and any(e.etype != compound for e in es)

    def fn(m: Models):
        tables = (m.stored() if twice else m).suite_tables()
        return Qy.run_expectations({k: tables[k] for k in {e.suite for e in es}}, es)
    return es, fn


for _key, _types, _rc in [
        ("expect_row_count", ("expect_table_row_count_to_be_between",), None),
        ("expect_not_null", ("expect_column_values_to_not_be_null",), None),
        ("expect_between", ("expect_column_values_to_be_between",), False),
        ("expect_between_where", ("expect_column_values_to_be_between",), True),
        ("expect_pair_greater", ("expect_column_pair_values_a_to_be_greater_than_b",), None),
        ("expect_in_set", ("expect_column_values_to_be_in_set",), None),
        ("expect_compound_unique", ("expect_compound_columns_to_be_unique",), None),
        ("expect_regex", ("expect_column_values_to_match_regex",), None),
        ("expect_date_parseable", ("expect_column_values_to_be_dateutil_parseable",), None),
        ("expect_stdev", ("expect_column_stdev_to_be_between",), None),
        ("quality_checkpoint", None, None)]:
    _es, _fn = _exps(_types, _rc)
    register(_key, O.expectations_sql(_es, Qy.EXPECTATIONS))(_fn)


# ---- ingest, validation, load ---------------------------------------------------------------------
from tickwise.plans import ingest_queries as Iq  # noqa: E402

for _key, _fn in Iq.SPARK.items():
    register(_key, Iq.SQL[_key])(_fn)


# ---- jobs with side effects -------------------------------------------------------------
from tickwise.plans import job_queries as Jq  # noqa: E402

for _key, _fn in Jq.SPARK.items():
    register(_key, Jq.SQL[_key])(_fn)
