"""Adapter from the driver's TPC-H-like tables to the three market inputs.

The test tables hold no market data, so raw price bars, macro observations
and asset metadata are derived from them by a fixed rule (FIXTURES.md §2).
Averages go through integer arithmetic so that any engine reproduces the
same doubles.

Plan shape at scale: ``lineitem`` is scanned once and joined to ``part``;
a single partial aggregation by (symbol, day) shrinks it to one row per
symbol and day before the only large shuffle. The benchmark bar is
re-aggregated from that result, so ``lineitem`` is not read a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.params import DEFAULT_PARAMS, Params

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _int_div_micro(num, den):
    """floor(num / den) on DECIMAL(38,0), as a double in units of 1e-6.

    Decimals keep a per-day sum over a very large table from overflowing a
    long; subtracting the remainder first makes the quotient exact.
    """
    return ((num - F.pmod(num, den)) / den).cast("long").cast("double") / F.lit(1e6)


def _rounded_mean_micro(sum_col, n_col):
    """round(100 * sum / n) micro-units: the mean of cents x percent."""
    s = sum_col.cast("decimal(38,0)")
    n = n_col.cast("decimal(38,0)")
    return _int_div_micro(s * 200 + n, n * 2)


def raw_bars(spark: SparkSession, sf_dir: str, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Raw daily bars: symbol, trade_date, open, high, low, close, adj_close,
    volume, source. 25 brand symbols plus the benchmark over all line items.

    One scan of ``lineitem``, one join to ``part`` and one aggregation by
    (symbol, day), partial on the map side, so the only large shuffle moves
    one row per symbol, day and task. The benchmark's totals come from a
    window over the day on those aggregated rows (sums, counts, min and max
    all combine), and one ``inline`` emits each symbol row plus one
    benchmark row per day: a single linear plan, the large input read once.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(pt, li.l_partkey == pt.p_partkey, "left")
    x = (F.round(F.col("l_extendedprice") * 100).cast("long")
         * F.round((1 - F.col("l_discount")) * 100).cast("long"))
    tup = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = j.select(
        F.regexp_replace(F.upper("p_brand"), "#", "").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        x.alias("x"), tup.alias("tup"),
        F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_extendedprice").alias("price"))
    g = (rows.groupBy("symbol", "trade_date")
             .agg(F.sum("x").alias("sum_x"), F.count(F.lit(1)).alias("n"),
                  F.sum("qty").alias("qty"), F.max("price").alias("high"),
                  F.min("price").alias("low"), F.min("tup").alias("first_t"),
                  F.max("tup").alias("last_t")))
    day = Window.partitionBy("trade_date")
    fields = ["sum_x", "n", "qty", "high", "low", "first_t", "last_t"]
    comb = {"sum_x": F.sum, "n": F.sum, "qty": F.sum, "high": F.max, "low": F.min,
            "first_t": F.min, "last_t": F.max}
    t = g.select("*", *[comb[c](c).over(day).alias(f"d_{c}") for c in fields],
                 F.row_number().over(day.orderBy(F.col("symbol").asc_nulls_first())).alias("rn"))
    own = F.when(F.col("symbol").isNotNull(), F.struct(
        F.col("symbol"), *[F.col(c) for c in fields]))
    bench = F.when(F.col("rn") == 1, F.struct(
        F.lit(params.benchmark).alias("symbol"), *[F.col(f"d_{c}").alias(c) for c in fields]))
    out = t.select("trade_date", F.inline(F.filter(F.array(own, bench), lambda e: e.isNotNull())))
    return _finish(out)


def _finish(g: DataFrame) -> DataFrame:
    return g.select(
        "symbol", "trade_date",
        F.col("first_t.l_extendedprice").alias("open"),
        "high", "low",
        F.col("last_t.l_extendedprice").alias("close"),
        _rounded_mean_micro(F.col("sum_x"), F.col("n")).alias("adj_close"),
        F.col("qty").cast("long").alias("volume"),
        F.lit("yahoo_finance").alias("source"))


# Which orders feed which macro series, the date grain and the
# divisor q (FIXTURES.md §2, "Macro").
PRIORITY_SERIES = [
    ("1-URGENT", "cdi", "day", 1000),
    ("2-HIGH", "selic_diaria", "day", 1000),
    ("3-MEDIUM", "usd_brl", "day", 10),
    ("4-NOT SPECIFIED", "eur_brl", "day", 10),
    ("5-LOW", "ipca", "month", 100),
]
STATUS_SERIES = [
    ("P", "igpm", "month", 100),
    ("F", "pib_mensal", "month", 1),
    ("O", "selic_meta", "month", 2),
]


def _series_struct(key_col: str, table_: list) -> F.Column:
    d = F.col("o_orderdate").cast("date")
    name = q = grain = None
    for key, s, g, qq in table_:
        cond = F.col(key_col) == key
        name = (F.when(cond, s) if name is None else name.when(cond, s))
        grain = (F.when(cond, g) if grain is None else grain.when(cond, g))
        q = (F.when(cond, qq) if q is None else q.when(cond, qq))
    obs = F.when(grain == "month", F.trunc(d, "MM")).otherwise(d)
    return F.struct(name.alias("series"), obs.alias("obs_date"), q.alias("q"))


def raw_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw macro observations: obs_date, series, value, unit, source.

    Each order feeds one priority series and one status series, so a single
    scan of ``orders`` with a two-element explode and one aggregation makes
    every series.
    """
    from tickwise.sources.landing import IPCA_UNIT, unit_col

    o = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    e = o.select("cents", F.explode(F.array(
        _series_struct("o_orderpriority", PRIORITY_SERIES),
        _series_struct("o_orderstatus", STATUS_SERIES))).alias("s"))
    g = (e.where(F.col("s.series").isNotNull())
          .groupBy(F.col("s.series").alias("series"), F.col("s.obs_date").alias("obs_date"),
                   F.col("s.q").alias("q"))
          .agg(F.sum("cents").alias("sc"), F.count(F.lit(1)).alias("n")))
    ipca = F.col("series") == "ipca"
    return g.select("obs_date", "series", _macro_value().alias("value"),
                    F.when(ipca, F.lit(IPCA_UNIT)).otherwise(unit_col()).alias("unit"),
                    F.when(ipca, "ibge").otherwise("bcb").alias("source"))


def _macro_value():
    s = F.col("sc").cast("decimal(38,0)")
    n = F.col("n").cast("decimal(38,0)")
    q = F.col("q").cast("decimal(38,0)")
    return _int_div_micro(s * 2 + q * n, q * n * 2)


def raw_assets(spark: SparkSession, sf_dir: str, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Asset metadata: one row per brand symbol of ``part`` plus the benchmark.

    The asset master is the instrument list, independent of trading (a
    brand without line items is still an asset). Reading it from ``part``
    rather than from the bars keeps every plan that joins assets to bars a
    single scan of ``lineitem``. name is NULL for even brand numbers and
    sector NULL for multiples of 5, so both staging fallbacks are exercised.
    """
    brands = (table(spark, sf_dir, "part")
              .select(F.regexp_replace(F.upper("p_brand"), "#", "").alias("symbol"))
              .where(F.col("symbol").isNotNull()).distinct())
    s = brands.unionByName(spark.range(1).select(F.lit(params.benchmark).alias("symbol")))
    n = F.regexp_extract("symbol", r"([0-9]+)$", 1)
    num = F.when(n != "", n.cast("int"))
    is_bench = F.col("symbol") == params.benchmark
    return s.select(
        "symbol",
        F.when(is_bench, F.lit("Benchmark index"))
         .when(num % 2 != 0, F.concat(F.lit("Company "), F.col("symbol"))).alias("name"),
        F.when(is_bench, F.lit("Index"))
         .when(num % 5 != 0, F.concat(F.lit("Sector "), (num / 10).cast("int").cast("string")))
         .alias("sector"),
        F.when(~is_bench, F.concat(F.lit("Industry "), (num % 10).cast("string"))).alias("subsector"),
        F.when(is_bench, F.lit("INDICE")).otherwise(F.lit("ACAO")).alias("kind"),
        F.lit("Brasil").alias("country"),
        F.lit("BRL").alias("currency"),
        F.lit(True).alias("active"))
