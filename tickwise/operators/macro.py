"""Macro wide table.

Everything here is keyed by date or month, i.e. bounded by the calendar:
a few thousand rows however many observations arrive. The pivots use a
fixed value list so no extra job is run to discover pivot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Output column per series in the daily and monthly pivots.
DAILY_PIVOT = [("selic_diaria", "selic_daily"), ("cdi", "cdi_daily"),
               ("usd_brl", "usd_brl"), ("eur_brl", "eur_brl")]
MONTHLY_PIVOT = [("ipca", "ipca_monthly"), ("igpm", "igpm_monthly"), ("selic_meta", "selic_target")]


def date_spine(stg: DataFrame) -> DataFrame:
    """Every date with at least one observation of any series."""
    return stg.select("obs_date").distinct()


def _pivot(stg: DataFrame, key, freq: str, spec) -> DataFrame:
    aggs = [F.max(F.when(F.col("series") == s, F.col("value"))).alias(out) for s, out in spec]
    return stg.where(F.col("frequency") == freq).groupBy(key).agg(*aggs)


def pivot_daily(stg: DataFrame) -> DataFrame:
    """One row per date, max value of each daily series."""
    return _pivot(stg, F.col("obs_date"), "diario", DAILY_PIVOT)


def pivot_monthly(stg: DataFrame) -> DataFrame:
    """One row per month of the monthly series. ``selic_meta`` is
    classified 'outro', so its column is always NULL (Q4), as in the model."""
    return _pivot(stg, F.trunc("obs_date", "MM").alias("month"), "mensal", MONTHLY_PIVOT)


def macro_wide(stg: DataFrame) -> DataFrame:
    """The date spine with the daily pivot of its date, the monthly
    pivot of its month, and the month-to-date running sum of the daily CDI
    (plain sum).

    Same result as the model's spine + two pivots + two joins, in one
    aggregate by date and one window by month: every monthly observation's
    date is itself a spine date, so the month's maximum over spine dates
    equals the monthly pivot.
    """
    daily, monthly = F.col("frequency") == "diario", F.col("frequency") == "mensal"
    v, s = F.col("value"), F.col("series")
    day = stg.groupBy("obs_date").agg(
        *[F.max(F.when(daily & (s == name), v)).alias(o) for name, o in DAILY_PIVOT],
        *[F.max(F.when(monthly & (s == name), v)).alias("m_" + o) for name, o in MONTHLY_PIVOT])
    wm = Window.partitionBy(F.trunc("obs_date", "MM"))
    run = wm.orderBy("obs_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return day.select("obs_date", *[o for _, o in DAILY_PIVOT],
                      *[F.max("m_" + o).over(wm).alias(o) for _, o in MONTHLY_PIVOT],
                      F.sum("cdi_daily").over(run).alias("cdi_mtd_sum"))


def macro_ffill(stg: DataFrame) -> DataFrame:
    """C11 (the intent in the model's comment): carry the last monthly value
    forward to every later spine date, across month boundaries.

    One linear plan: an aggregate to one row per spine date, the month's
    value spread over its dates by a window over the month, then the carry
    by a window ordered over the date table. That table has one row per
    calendar date, so its single ordered window is bounded by the calendar.
    """
    monthly = F.col("frequency") == "mensal"
    day = stg.groupBy("obs_date").agg(*[
        F.max(F.when(monthly & (F.col("series") == name), F.col("value"))).alias("m_" + o)
        for name, o in MONTHLY_PIVOT])
    wm = Window.partitionBy(F.trunc("obs_date", "MM"))
    month_val = day.select("obs_date", *[F.max("m_" + o).over(wm).alias(o) for _, o in MONTHLY_PIVOT])
    w = Window.orderBy("obs_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return month_val.select("obs_date", *[
        F.last(o, ignorenulls=True).over(w).alias(o) for _, o in MONTHLY_PIVOT])
