"""Parameterised macros and consumer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.num import rnd
from tickwise.params import DEFAULT_PARAMS, Params


def period_return(fact: DataFrame, start: str, end: str,
                  symbols: list[str] | None = None) -> DataFrame:
    """H1: exp(sum(log return)) - 1 per symbol over [start, end] inclusive.
    The macro leaves it unrounded; 8 places here so engines agree."""
    f = fact.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
                   & F.col("log_return").isNotNull())
    if symbols is not None:
        f = f.where(F.col("symbol").isin(*symbols))
    return f.groupBy("symbol").agg(rnd(F.exp(F.sum("log_return")) - 1, 8).alias("period_return"))


def session_gaps(df: DataFrame, date_col: str = "trade_date", symbol_col: str = "symbol",
                 max_days: int = 10) -> DataFrame:
    """H2: gaps of more than ``max_days`` calendar days between consecutive
    rows of a symbol, unless the previous day is a Friday or Saturday."""
    w = Window.partitionBy(symbol_col).orderBy(date_col)
    prev = F.lag(date_col).over(w)
    x = df.select(F.col(symbol_col).alias("symbol"), F.col(date_col).alias("curr_date"),
                  prev.alias("prev_date"))
    x = x.withColumn("gap_days", F.datediff("curr_date", "prev_date"))
    return x.where((F.col("gap_days") > max_days) & ~F.dayofweek("prev_date").isin(6, 7))


def asset_overview(dim: DataFrame) -> DataFrame:
    """The asset list with its current snapshot, ordered by kind, sector."""
    return (dim.select("symbol", "name", "sector", "kind", "last_price", "ytd_return",
                       "current_vol", "current_beta", "risk_profile")
               .orderBy("kind", "sector", "symbol"))


def base100_prices(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Each symbol's price / its price on the global first date x 100;
    NULL for a symbol without a price on that date. The first date is a
    scalar subquery, the base prices one row per symbol."""
    f = fact.where(F.col("symbol") != params.benchmark).select("symbol", "trade_date", "adj_close")
    first = f.select(F.min("trade_date")).scalar()
    base = f.where(F.col("trade_date") == first).select(
        "symbol", F.col("adj_close").alias("base_price"))
    j = f.join(base, "symbol", "left")
    return j.select("symbol", "trade_date", "adj_close",
                    rnd(F.col("adj_close") / F.col("base_price") * 100, 6).alias("base100"))


def top_sharpe(risk: DataFrame, year: int | None = None, k: int = 5) -> DataFrame:
    """N4 + N6: the year's top-k by Sharpe (NULLs first, as a SQL DESC
    sort does), with the chart marker size max(sharpe, 0) * 200 + 50."""
    y = F.lit(year) if year is not None else risk.select(F.max("year")).scalar()
    r = risk.where(F.col("year") == y)
    s = F.col("sharpe")
    size = F.when(s.isNotNull(), F.greatest(s, F.lit(0.0)) * 200 + 50)
    return (r.select("symbol", "year", "annual_return_pct", "volatility_pct", "sharpe",
                     "max_drawdown_pct", "win_rate_pct", "var_95_pct", size.alias("marker_size"))
             .orderBy(s.desc_nulls_first(), F.col("symbol")).limit(k))


# The series and frequencies the macro chart shows.
HISTORY_SERIES = ("selic_meta", "ipca", "usd_brl", "cdi")
HISTORY_FREQUENCIES = ("diario", "mensal")


def macro_history(stg_macro: DataFrame) -> DataFrame:
    """Chosen series history (selic_meta is classified 'outro', so it
    never appears, Q4)."""
    return (stg_macro.where(F.col("series").isin(*HISTORY_SERIES)
                            & F.col("frequency").isin(*HISTORY_FREQUENCIES))
                     .select("obs_date", "series", F.col("value").cast("double").alias("value"))
                     .orderBy("obs_date"))
