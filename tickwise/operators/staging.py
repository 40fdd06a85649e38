"""Staging models: clean and type the three raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE_COLS = ("open", "high", "low", "close", "adj_close")

# Series names per frequency and per economic group.
DAILY_SERIES = ("selic_diaria", "cdi", "usd_brl", "eur_brl")
MONTHLY_SERIES = ("ipca", "igpm", "pib_mensal")
RATE_SERIES = ("selic_meta", "selic_diaria", "cdi")
INFLATION_SERIES = ("ipca", "igpm")
FX_SERIES = ("usd_brl", "eur_brl")
ACTIVITY_SERIES = ("pib_mensal",)
SECTOR_FALLBACK = "Não informado"


def stg_bars(raw: DataFrame) -> DataFrame:
    """Keep rows with a positive adjusted close and a date; a zero
    price becomes NULL (negatives pass, as in the model); prices typed
    DECIMAL(18,6); a NULL volume becomes 0."""
    adj = F.col("adj_close")
    kept = raw.where(adj.isNotNull() & (adj > 0) & F.col("trade_date").isNotNull())
    cols = [F.col("symbol"), F.col("trade_date").cast("date").alias("trade_date")]
    cols += [F.nullif(F.col(c), F.lit(0)).cast("decimal(18,6)").alias(c) for c in PRICE_COLS]
    cols += [F.coalesce(F.col("volume"), F.lit(0)).cast("long").alias("volume"), F.col("source")]
    if "loaded_at" in raw.columns:
        cols.append(F.col("loaded_at"))
    return kept.select(*cols)


def _in(c, values):
    return F.col(c).isin(*values)


def stg_macro(raw: DataFrame) -> DataFrame:
    """Drop NULL values, lower-case the name, DECIMAL(18,6), and
    classify frequency and group. As in the model, both classifications
    test the raw (not lower-cased) name."""
    freq = (F.when(_in("series", DAILY_SERIES), "diario")
             .when(_in("series", MONTHLY_SERIES), "mensal").otherwise("outro"))
    grp = (F.when(_in("series", RATE_SERIES), "juros")
            .when(_in("series", INFLATION_SERIES), "inflacao")
            .when(_in("series", FX_SERIES), "cambio")
            .when(_in("series", ACTIVITY_SERIES), "atividade").otherwise("outro"))
    cols = [F.col("obs_date").cast("date").alias("obs_date"),
            F.lower("series").alias("series"),
            F.col("value").cast("decimal(18,6)").alias("value"),
            "unit", "source", freq.alias("frequency"), grp.alias("series_group")]
    if "loaded_at" in raw.columns:
        cols.insert(5, "loaded_at")
    return raw.where(F.col("value").isNotNull()).select(*cols)


def stg_assets(raw: DataFrame) -> DataFrame:
    """Name falls back to the symbol, sector to a fixed text; kind and
    currency upper-cased; rows without a symbol dropped."""
    return (raw.where(F.col("symbol").isNotNull())
               .select("symbol",
                       F.coalesce("name", "symbol").alias("name"),
                       F.coalesce(F.col("sector"), F.lit(SECTOR_FALLBACK)).alias("sector"),
                       "subsector", F.upper("kind").alias("kind"), "country",
                       F.upper("currency").alias("currency"), "active"))
