"""Price fact (D1-D12): returns, rolling risk, macro of the day, benchmark.

The bars are exchanged by symbol for the lag, by date to put the benchmark
beside each row (a window, so the input is read once) and by symbol again for
the other windows (volatility, cumulative, YTD, beta). The macro table is
joined on date: AQE broadcasts it if it has measured it to be small, and
shuffles both sides otherwise. With ``params.segmented`` the windows run over
segments of a symbol's history (``segments``), which then needs no bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import rnd, surrogate_key
from tickwise.operators import macro as M, segments as Sg
from tickwise.operators import series as S
from tickwise.params import DEFAULT_PARAMS, Params

FACT_COLUMNS = [
    "id", "symbol", "trade_date", "adj_close", "prev_adj_close", "volume",
    "simple_return", "log_return", "return_pct", "cum_return", "ytd_return",
    "ann_vol", "beta", "selic_daily", "cdi_daily", "usd_brl", "ipca_monthly",
    "selic_target", "real_return", "excess_return", "bench_return", "bench_level",
    "days_since_prev"]


def real_return_col():
    """(1 + r) / (1 + ipca/100) - 1, NULL when ipca is NULL or 0."""
    ipca = F.col("ipca_monthly").cast("double")
    r = F.col("simple_return")
    return F.when(ipca.isNotNull() & (ipca != 0), rnd((1 + r) / (1 + ipca / 100) - 1, 8))


def excess_return_col():
    """R - cdi/100, NULL when the day has no CDI."""
    cdi = F.col("cdi_daily").cast("double")
    return F.when(cdi.isNotNull(), rnd(F.col("simple_return") - cdi / 100, 8))


def price_fact(stg_bars: DataFrame, stg_macro: DataFrame,
               params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The fact table, one row per (symbol, date) after each symbol's
    first bar."""
    if params.segmented:
        x = Sg.segmented_windows(stg_bars, params)
    else:
        ret = S.with_benchmark(S.daily_returns(stg_bars), params)
        x = S.with_rolling_beta(ret.select(
            "*",
            S.rolling_volatility_col(params).alias("ann_vol"),
            S.cumulative_return_col().alias("cum_return"),
            S.ytd_return_col().alias("ytd_return")), params)
    return fact_rows(x, stg_macro)


def fact_rows(x: DataFrame, stg_macro: DataFrame) -> DataFrame:
    """The fact's columns, from windowed returns and the macro of the day."""
    wide = M.macro_wide(stg_macro).withColumnRenamed("obs_date", "trade_date")
    j = x.join(wide, "trade_date", "left")
    return j.select(
        surrogate_key("symbol", "trade_date").alias("id"),
        "symbol", "trade_date",
        F.col("adj_close").cast("double").alias("adj_close"),
        F.col("prev_adj_close").cast("double").alias("prev_adj_close"),
        "volume", "simple_return", "log_return",
        rnd(F.col("simple_return") * 100, 4).alias("return_pct"),
        "cum_return", "ytd_return", "ann_vol", "beta",
        *[F.col(c).cast("double").alias(c) for c in
          ("selic_daily", "cdi_daily", "usd_brl", "ipca_monthly", "selic_target")],
        real_return_col().alias("real_return"),
        excess_return_col().alias("excess_return"),
        "bench_return", "bench_level", "days_since_prev")
