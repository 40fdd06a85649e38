"""Asset dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import rnd, safe_div, surrogate_key


def risk_profile_col(vol="current_vol"):
    """< 0.20 baixo, < 0.40 medio, anything else (NULL too) alto."""
    v = F.col(vol)
    return F.when(v < 0.20, "baixo").when(v < 0.40, "medio").otherwise("alto")


def _stats_aggs():
    p = F.col("adj_close").cast("double")
    return [F.count(F.lit(1)).alias("sessions"),
            F.min("trade_date").alias("first_date"),
            F.max("trade_date").alias("last_date"),
            rnd(F.avg(p), 2).alias("avg_price"),
            rnd(F.min(p), 2).alias("min_price"),
            rnd(F.max(p), 2).alias("max_price"),
            rnd(F.avg(F.col("volume").cast("double")), 0).alias("avg_daily_volume")]


def asset_stats(fact: DataFrame) -> DataFrame:
    """Per-asset session count, first/last date, price and volume stats."""
    return fact.groupBy("symbol").agg(*_stats_aggs())


def zero_mean_variance(fact: DataFrame) -> DataFrame:
    """sum(r^2) / (count(r) - 1), guarded, 8 places."""
    r = F.col("simple_return")
    return fact.groupBy("symbol").agg(
        rnd(safe_div(F.sum(r * r), F.count(r) - 1), 8).alias("zero_mean_variance"))


def _snapshot_agg():
    return F.max_by(F.struct(
        F.col("trade_date").alias("snapshot_date"),
        F.col("adj_close").cast("double").alias("last_price"),
        F.col("cum_return").alias("cum_return_total"),
        F.col("ytd_return").alias("ytd_return"),
        F.col("ann_vol").alias("current_vol"),
        F.col("beta").alias("current_beta")), F.col("trade_date")).alias("snap")


def latest_snapshot(fact: DataFrame) -> DataFrame:
    """The latest row per asset, as an aggregate (no sort)."""
    return fact.groupBy("symbol").agg(_snapshot_agg()).select("symbol", "snap.*")


def year_parts(fact: DataFrame) -> DataFrame:
    """E1 and E3 by (symbol, year), in a form that merges: what a refresh
    keeps of the years it doesn't read."""
    p = F.col("adj_close").cast("double")
    return fact.groupBy("symbol", F.year("trade_date").alias("year")).agg(
        F.count(F.lit(1)).alias("sessions"), F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"), F.sum(p).alias("price_sum"), F.count(p).alias("prices"),
        F.min(p).alias("min_price"), F.max(p).alias("max_price"),
        F.sum(F.col("volume").cast("double")).alias("volume_sum"), F.count("volume").alias("volumes"), _snapshot_agg())


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row of E1 and E3 a symbol, from ``year_parts``."""
    return parts.groupBy("symbol").agg(
        F.sum("sessions").alias("sessions"), F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        rnd(safe_div(F.sum("price_sum"), F.sum("prices")), 2).alias("avg_price"),
        rnd(F.min("min_price"), 2).alias("min_price"), rnd(F.max("max_price"), 2).alias("max_price"),
        rnd(safe_div(F.sum("volume_sum"), F.sum("volumes")), 0).alias("avg_daily_volume"),
        F.max_by("snap", "year").alias("snap"))


def asset_dim(stg_assets: DataFrame, fact: DataFrame) -> DataFrame:
    """E5: assets with stats and latest snapshot; E1 and E3 share one
    aggregate over the fact."""
    return dim_rows(stg_assets, fact.groupBy("symbol").agg(*_stats_aggs(), _snapshot_agg()))


def dim_rows(stg_assets: DataFrame, agg: DataFrame) -> DataFrame:
    """The dimension's columns, from the assets and one row of stats and
    snapshot a symbol."""
    j = stg_assets.join(agg, "symbol", "left")
    return j.select(
        surrogate_key("symbol").alias("id"),
        "symbol", "name", "sector", "subsector", "kind", "country", "currency", "active",
        "sessions", "first_date", "last_date", "avg_price", "min_price", "max_price",
        "avg_daily_volume",
        F.col("snap.last_price").alias("last_price"),
        F.col("snap.cum_return_total").alias("cum_return_total"),
        F.col("snap.ytd_return").alias("ytd_return"),
        F.col("snap.current_vol").alias("current_vol"),
        F.col("snap.current_beta").alias("current_beta"),
        risk_profile_col("snap.current_vol").alias("risk_profile"))
