"""Record validation and quarantine.

Each validator normalises the record as the reference's record models do
and adds ``reasons``: an array of failed rules, empty when the row is
valid. One projection computes every rule, so validation is a map-only
stage; ``quarantine`` explodes the reasons of rejected rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_COLS = ("open", "high", "low", "close", "adj_close")
KIND_PATTERN = "^(ACAO|FII|ETF|INDICE)$"


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def validate_bars(df: DataFrame) -> DataFrame:
    """Symbol trimmed + upper-cased and non-empty; a date is required;
    each non-NULL price > 0; high >= low when both are present; the whole
    row is rejected on any
    failure. NaN prices (which pass ``<= 0`` in Python) and a NaN volume are
    rejected too (Q11, a documented deviation)."""
    sym = F.upper(F.trim(F.col("symbol")))
    rules = [(sym.isNull() | (sym == ""), "empty_symbol"),
             (F.col("trade_date").isNull(), "missing_date")]
    for c in PRICE_COLS:
        x = F.col(c)
        rules.append((x.isNotNull() & F.isnan(x), f"{c}_nan"))
        rules.append((x.isNotNull() & ~F.isnan(x) & (x <= 0), f"{c}_not_positive"))
    hi, lo = F.col("high"), F.col("low")
    rules.append((hi.isNotNull() & lo.isNotNull() & ~F.isnan(hi) & ~F.isnan(lo) & (hi < lo),
                  "high_below_low"))
    if "volume_raw" in df.columns:
        rules.append((F.col("volume_raw").isNotNull() & F.isnan("volume_raw"), "volume_nan"))
    out = df.withColumn("symbol", sym).withColumn("reasons", _reasons(*rules))
    return out.withColumn("is_valid", F.size("reasons") == 0)


def validate_macro(df: DataFrame) -> DataFrame:
    """Series trimmed + lower-cased and non-empty; value required;
    unit defaults to '%', source to 'bcb'."""
    ser = F.lower(F.trim(F.col("series")))
    rules = [(ser.isNull() | (ser == ""), "empty_series"),
             (F.col("value").isNull(), "missing_value"),
             (F.col("obs_date").isNull(), "missing_date")]
    out = (df.withColumn("series", ser)
             .withColumn("unit", F.coalesce(F.col("unit"), F.lit("%")))
             .withColumn("source", F.coalesce(F.col("source"), F.lit("bcb")))
             .withColumn("reasons", _reasons(*rules)))
    return out.withColumn("is_valid", F.size("reasons") == 0)


def validate_assets(df: DataFrame) -> DataFrame:
    """Kind must match the pattern; symbol trimmed + upper-cased (no
    emptiness rule here, as in the reference); country, currency and active
    take their defaults."""
    kind = F.col("kind")
    rules = [(kind.isNull() | ~kind.rlike(KIND_PATTERN), "bad_kind"),
             (F.col("symbol").isNull(), "missing_symbol")]
    out = (df.withColumn("symbol", F.upper(F.trim(F.col("symbol"))))
             .withColumn("country", F.coalesce(F.col("country"), F.lit("Brasil")))
             .withColumn("currency", F.coalesce(F.col("currency"), F.lit("BRL")))
             .withColumn("active", F.coalesce(F.col("active"), F.lit(True)))
             .withColumn("reasons", _reasons(*rules)))
    return out.withColumn("is_valid", F.size("reasons") == 0)


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("is_valid")).drop("reasons", "is_valid")


def quarantine(validated: DataFrame, entity: str, key_cols: list[str]) -> DataFrame:
    """One row per (rejected record, reason), with the record key as text."""
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    return (validated.where(~F.col("is_valid"))
                     .select(F.lit(entity).alias("entity"), key.alias("record_key"),
                             F.explode("reasons").alias("reason")))


def quarantine_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
