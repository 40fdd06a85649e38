"""Readers and parsers for landed source data.

The reference pulls frames and JSON over HTTP one symbol or series at a
time. Here the fetched payloads are landed files (or strings derived from
tables) and one distributed read parses all of them; a bad record or file
becomes a quarantined row instead of stopping its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit of each macro series; anything else is '%'.
SERIES_UNITS = {
    "selic_meta": "% a.a.",
    "selic_diaria": "% a.d.",
    "usd_brl": "BRL",
    "eur_brl": "BRL",
    "igpm": "% mês",
    "cdi": "% a.d.",
    "pib_mensal": "índice",
}
IPCA_UNIT = "% mês"
DEFAULT_UNIT = "%"
DEFAULT_BAR_SOURCE = "yahoo_finance"

# Landed price history: the API frame after reset_index, one file per symbol.
LANDED_BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Adj Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
])

DAILY_SERIES_SCHEMA = "array<struct<data:string,valor:string>>"
NESTED_SERIES_SCHEMA = ("array<struct<resultados:array<struct<series:"
                        "array<struct<serie:map<string,string>>>>>>>")


def unit_col(series_col: str = "series") -> Column:
    """A5: the unit of a series from a literal map (no join), default '%'."""
    m = F.create_map(*[F.lit(x) for kv in SERIES_UNITS.items() for x in kv])
    return F.coalesce(m[F.col(series_col)], F.lit(DEFAULT_UNIT))


def unit_lookup(df: DataFrame, series_col: str = "series") -> DataFrame:
    """A5: attach the unit of each series."""
    return df.withColumn("unit", unit_col(series_col))


def normalise_columns(df: DataFrame) -> DataFrame:
    """A1: column names lower-cased with '_' for a space."""
    return df.select([F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in df.columns])


def _zero_to_null(c: Column) -> Column:
    """A2: ``float(x or 0) or None``: absent or zero becomes NULL."""
    return F.nullif(F.coalesce(c, F.lit(0)), F.lit(0))


def ingest_bars(frame: DataFrame, start: str | None = None, end: str | None = None,
                source: str = DEFAULT_BAR_SOURCE, keep: tuple[str, ...] = (),
                symbols: list[str] | None = None) -> DataFrame:
    """A1-A3: API-shaped frame(s) -> raw bars.

    ``frame`` carries a ``symbol`` column and the API columns (any case,
    spaces allowed). Zero or absent prices and volume become NULL; the
    adjusted close falls back to the close only when that column is absent
    (not when a value is NULL). The range is [start, end), as the API's.
    A NaN volume is kept as NaN in ``volume_raw`` for validation to reject.
    Columns named in ``keep`` are carried through unchanged; ``symbols``
    (e.g. from ``parse_symbol_list``) restricts the symbols loaded.
    """
    df = normalise_columns(frame)
    keep = tuple(c.lower().replace(" ", "_") for c in keep)
    cols = set(df.columns)
    adj = F.col("adj_close") if "adj_close" in cols else F.col("close")
    price = {c: _zero_to_null(F.col(c).cast("double")) if c in cols else F.lit(None).cast("double")
             for c in ("open", "high", "low", "close")}
    vol = F.col("volume").cast("double") if "volume" in cols else F.lit(None).cast("double")
    out = df.select(
        F.col("symbol"),
        F.col("date").cast("date").alias("trade_date"),
        price["open"].alias("open"), price["high"].alias("high"),
        price["low"].alias("low"), price["close"].alias("close"),
        _zero_to_null(adj.cast("double")).alias("adj_close"),
        F.when(~F.isnan(vol), _zero_to_null(vol).cast("long")).alias("volume"),
        vol.alias("volume_raw"),
        F.lit(source).alias("source"), *[F.col(f"`{c}`") for c in keep])
    if symbols is not None:
        out = out.where(F.col("symbol").isin(*symbols))
    if start:
        out = out.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end:
        out = out.where(F.col("trade_date") < F.lit(end).cast("date"))
    return out


def read_landed_bars(spark: SparkSession, path: str, fmt: str = "parquet",
                     schema: T.StructType = LANDED_BAR_SCHEMA) -> DataFrame:
    """A1/A10: one read over every landed price file, explicit schema.

    For text formats a malformed line lands in ``_corrupt_record`` (mode
    PERMISSIVE) instead of failing the read. Of Parquet, the files that
    ``damaged_files`` lists are left out whole, so one bad file or symbol does
    not stop the others; all other files are read strictly: an error there
    fails the task (Spark tries it again) and drops no row. The list is made
    when this is called, by a pass over the files.
    """
    if fmt == "parquet":
        damaged = [r[0] for r in _damaged(spark, path, schema).select("file").collect()]
        return (spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(path)
                .where(~F.col("_metadata.file_path").isin(damaged)))
    r = spark.read.schema(schema)
    if fmt in ("json", "csv"):
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        r = (spark.read.schema(schema).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", "_corrupt_record"))
        if fmt == "csv":
            r = r.option("header", "true")
    return r.format(fmt).load(path)


def landed_files(spark: SparkSession, path: str, schema: T.StructType = LANDED_BAR_SCHEMA) -> DataFrame:
    """file, rows_footer and rows_read of each Parquet file below ``path``:
    the rows its footer counts (0 without a footer) and those of which every
    column of ``schema`` could be read. Without columns Spark counts from the
    footers; the hash makes the second count read them all."""
    file = F.col("_metadata.file_path").alias("file")
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(file)
    lax = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    footer = lax.groupBy(file).agg(F.count(F.lit(1)).alias("rows_footer"))
    read = (lax.select(file, F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("h"))
            .groupBy("file").agg((F.count_if(F.col("h") >= 0) + F.count_if(F.col("h") < 0)).alias("rows_read")))
    return (landed.join(footer, "file", "left").join(read, "file", "left")
            .na.fill(0, ["rows_footer", "rows_read"]))


def _damaged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (landed_files(spark, path, schema)
            .where((F.col("rows_footer") == 0) | (F.col("rows_read") < F.col("rows_footer"))))


def damaged_files(spark: SparkSession, path: str, schema: T.StructType = LANDED_BAR_SCHEMA) -> DataFrame:
    """A10 for landed Parquet: entity, record_key (the file) and reason of each
    file below ``path`` that ``read_landed_bars`` leaves out, in the columns of
    the quarantine: ``no_rows`` (no footer, or a fetch that brought nothing) or
    ``rows_lost`` (fewer rows can be read than its footer counts)."""
    return _damaged(spark, path, schema).select(
        F.lit("bars").alias("entity"), _same_name("file").alias("record_key"),
        F.when(F.col("rows_footer") == 0, "no_rows").otherwise("rows_lost").alias("reason"))


def rowless_files(spark: SparkSession, path: str, schema: T.StructType = LANDED_BAR_SCHEMA) -> DataFrame:
    """Of ``damaged_files``, those that give no row at all."""
    return damaged_files(spark, path, schema).where("reason = 'no_rows'")


def _same_name(path: str) -> Column:
    """A file's name as a URI, with an empty host: ``file:///`` for ``file:/``."""
    return F.regexp_replace(F.col(path), "^([a-z0-9]+):/+(?=[^/])", "$1:///")


def parse_daily_series(docs: DataFrame, series_col: str = "series",
                       doc_col: str = "doc") -> DataFrame:
    """A4: JSON arrays of {data: 'DD/MM/YYYY', valor} -> one row per item.

    A value given as text may use a decimal comma. Rows whose date or value
    does not parse keep NULLs and a ``reason``; ``macro_records`` splits
    them off. Unparseable documents yield a single row with reason
    'bad_document'.
    """
    arr = F.from_json(F.col(doc_col), DAILY_SERIES_SCHEMA)
    x = docs.select(F.col(series_col).alias("series"), arr.alias("items"))
    unread = F.col("items").isNull()
    e = (x.where(unread | (F.size("items") > 0))
          .select("series", unread.alias("unread"), F.explode_outer("items").alias("it")))
    d = F.try_to_date(F.col("it.data"), "d/M/y")
    v = F.expr("try_cast(replace(it.valor, ',', '.') AS DOUBLE)")
    return e.select(
        F.trim(F.col("series")).alias("series"), d.alias("obs_date"), v.alias("value"),
        F.when(F.col("unread"), "bad_document")
         .when(d.isNull(), "bad_date").when(v.isNull(), "bad_value").alias("reason"),
        F.col("it.data").alias("raw_date"))


def parse_nested_series(docs: DataFrame, series_name: str = "ipca",
                        doc_col: str = "doc") -> DataFrame:
    """Variable -> resultados -> first ``series`` entry only -> map of
    'YYYYMM' -> value, dated the first of the month (Q17: later entries are
    ignored, as in the reference). A document, variable or result without
    that structure yields one row with reason 'bad_document'."""
    arr = F.from_json(F.col(doc_col), NESTED_SERIES_SCHEMA)
    v = docs.select(F.explode_outer(arr).alias("var"))
    r = v.select(F.explode_outer("var.resultados").alias("res"))
    first = F.try_element_at(F.col("res.series"), F.lit(1))
    m = r.select(F.explode_outer(first.getField("serie")).alias("period", "raw"))
    d = F.try_to_date(F.concat(F.col("period"), F.lit("01")), "yyyyMMdd")
    val = F.expr("try_cast(raw AS DOUBLE)")
    return m.select(
        F.lit(series_name).alias("series"), d.alias("obs_date"), val.alias("value"),
        F.when(F.col("period").isNull(), "bad_document")
         .when(d.isNull(), "bad_date").when(val.isNull(), "bad_value").alias("reason"),
        F.col("period").alias("raw_date"))


def macro_records(parsed: DataFrame, source: str = "bcb", unit: str | None = None) -> DataFrame:
    """Parsed observations that passed, in the raw macro shape.
    ``unit`` overrides the per-series lookup (the monthly source sets its own)."""
    ok = parsed.where(F.col("reason").isNull())
    out = ok.select("obs_date", F.lower(F.trim("series")).alias("series"), "value",
                    F.lit(source).alias("source"))
    out = unit_lookup(out) if unit is None else out.withColumn("unit", F.lit(unit))
    return out.select("obs_date", "series", "value", "unit", "source")


def macro_rejects(parsed: DataFrame) -> DataFrame:
    """Parsed observations that failed, as quarantine rows (entity,
    record_key: raw date and series, reason)."""
    key = F.concat_ws("|", F.coalesce("raw_date", F.lit("")), F.coalesce("series", F.lit("")))
    return (parsed.where(F.col("reason").isNotNull())
                  .select(F.lit("macro").alias("entity"), key.alias("record_key"), "reason"))


def to_source_date(c) -> Column:
    """ISO date -> 'DD/MM/YYYY' as the daily API expects."""
    return F.date_format(c, "dd/MM/yyyy")


def to_period(c) -> Column:
    """Date -> 'YYYYMM' as the monthly API expects."""
    return F.date_format(c, "yyyyMM")


def asset_metadata(config: DataFrame, info: DataFrame) -> DataFrame:
    """Configured metadata, else looked-up info, else the symbol.

    Python's ``or`` also skips an empty string, hence ``nullif(x, '')``.
    kind defaults to ACAO and currency to BRL; country and active take the
    record defaults.
    """
    j = config.join(info, "symbol", "left")
    return j.select(
        "symbol",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("long_name"), F.col("symbol"))
         .alias("name"),
        F.coalesce(F.nullif(F.col("sector"), F.lit("")), F.col("info_sector")).alias("sector"),
        F.col("industry").alias("subsector"),
        F.coalesce(F.col("kind"), F.lit("ACAO")).alias("kind"),
        F.lit("Brasil").alias("country"),
        F.coalesce(F.col("info_currency"), F.lit("BRL")).alias("currency"),
        F.lit(True).alias("active"))


def parse_symbol_list(c) -> Column:
    """Split a comma list and trim each entry (empty entries kept)."""
    return F.transform(F.split(c, ","), lambda s: F.trim(s))
