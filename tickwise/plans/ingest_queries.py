"""Ingest, validation and load queries (A1-A20) over data derived from the
given tables: the adapter's bars and macro series are turned back into the
shapes the sources deliver (API frames, JSON documents) and run through
the same readers, validators and upserts a production load uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import staging as St, upsert as U, validate as V
from tickwise.plans import oracle as O
from tickwise.plans.context import Models
from tickwise.sources import landing as Ld


def api_frame(bars: DataFrame, with_adj: bool = True) -> DataFrame:
    """Raw bars in the API's column names (what a landed price file holds)."""
    cols = [F.col("symbol"), F.col("trade_date").alias("Date"), F.col("open").alias("Open"),
            F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close")]
    if with_adj:
        cols.append(F.col("adj_close").alias("Adj Close"))
    cols.append(F.col("volume").cast("double").alias("Volume"))
    return bars.select(*cols)


def ingest(m: Models) -> DataFrame:
    return Ld.ingest_bars(api_frame(m.raw_bars)).drop("volume_raw")


def zero_frame(m: Models) -> DataFrame:
    b = m.raw_bars
    return b.select("symbol", F.col("trade_date").alias("Date"),
                    F.when(F.col("volume") % 5 == 0, F.lit(0.0)).otherwise(F.col("open")).alias("Open"),
                    F.col("high").alias("High"), F.col("low").alias("Low"),
                    F.col("close").alias("Close"), F.col("adj_close").alias("Adj Close"),
                    (F.col("volume") % 4).cast("double").alias("Volume"))


def daily_docs(m: Models) -> DataFrame:
    """Daily series as the source serves them: one JSON array per (series,
    month) of {data: DD/MM/YYYY, valor: text with a decimal comma}. A
    document holds at most 31 items."""
    d = m.raw_macro.where(F.col("series").isin(*St.DAILY_SERIES))
    it = F.struct(Ld.to_source_date("obs_date").alias("data"),
                  F.regexp_replace(F.col("value").cast("string"), r"\.", ",").alias("valor"))
    return (d.select("series", F.trunc("obs_date", "MM").alias("month"), it.alias("it"))
             .groupBy("series", "month").agg(F.to_json(F.collect_list("it")).alias("doc")))


def nested_docs(m: Models) -> DataFrame:
    """The monthly series as the other source serves it: per year, variable ->
    resultados -> series[ {serie: {YYYYMM: value}}, a second locality ]."""
    ip = m.raw_macro.where(F.col("series") == "ipca")
    g = (ip.select(F.year("obs_date").alias("y"),
                   F.struct(Ld.to_period("obs_date").alias("k"),
                            F.col("value").cast("string").alias("v")).alias("e"))
           .groupBy("y").agg(F.map_from_entries(F.collect_list("e")).alias("serie")))
    other = F.create_map(F.lit("190001"), F.lit("999"))
    series = F.array(F.struct(F.col("serie").alias("serie")), F.struct(other.alias("serie")))
    doc = F.to_json(F.array(F.struct(F.array(F.struct(series.alias("series"))).alias("resultados"))))
    return g.select(doc.alias("doc"))


def part_info(m: Models) -> DataFrame:
    """Looked-up asset info derived from ``part``, one row per brand symbol."""
    p = m.table("part").select(F.regexp_replace(F.upper("p_brand"), "#", "").alias("symbol"), "p_type")
    g = p.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("p_type").alias("s1"),
                                F.max("p_type").alias("s2"))
    return g.select("symbol",
                    F.concat(F.col("symbol"), F.lit(" holding "), F.col("n").cast("string")).alias("long_name"),
                    F.when(F.col("n") % 3 != 0, F.col("s1")).alias("info_sector"),
                    F.col("s2").alias("industry"),
                    F.when(F.col("n") % 2 == 0, F.lit("USD")).alias("info_currency"))


CUT_TARGET, CUT_BATCH, CUT_SECOND = "1998-12-31", "1998-07-01", "1999-01-01"


def bar_target(m: Models) -> DataFrame:
    return m.raw_bars.where(F.col("trade_date") <= F.lit(CUT_TARGET).cast("date"))


def bar_batch(m: Models, seq: int | None = None) -> DataFrame:
    b = m.raw_bars.where(F.col("trade_date") >= F.lit(CUT_BATCH).cast("date")).select(
        "symbol", "trade_date", "open", "high", "low", "close",
        (F.col("adj_close") * 2).alias("adj_close"),
        F.when(F.col("symbol") != m.params.benchmark, F.col("volume")).alias("volume"),
        F.lit("b3").alias("source"))
    return b if seq is None else b.withColumn("batch_seq", F.lit(seq))


def bar_batch2(m: Models) -> DataFrame:
    b = m.raw_bars.where(F.col("trade_date") >= F.lit(CUT_SECOND).cast("date")).select(
        "symbol", "trade_date", "open", "high", "low", "close",
        (F.col("adj_close") * 4).alias("adj_close"), "volume",
        F.lit("manual").alias("source"), F.lit(2).alias("batch_seq"))
    return b


def asset_batch(m: Models) -> DataFrame:
    a = m.raw_assets
    return a.select("symbol", F.upper(F.coalesce("name", "symbol")).alias("name"),
                    F.lower("sector").alias("sector"), F.lit(None).cast("string").alias("subsector"),
                    F.when(F.col("kind") == "ACAO", F.lit("FII")).otherwise(F.col("kind")).alias("kind"),
                    F.lit("Portugal").alias("country"), F.lit("EUR").alias("currency"),
                    F.lit(False).alias("active"))


def dirty_frame(m: Models) -> DataFrame:
    """The zero frame with a failing row for each rule, by the day's volume."""
    v, nan = F.col("volume"), F.lit(float("nan"))

    def spoil(n: int, bad, good):
        return F.when(v % n == 0, bad).otherwise(good)
    return m.raw_bars.select(
        spoil(29, F.lit("  "), F.col("symbol")).alias("symbol"),
        F.when(v % 31 != 0, F.col("trade_date")).alias("Date"),
        spoil(5, F.lit(0.0), spoil(7, -F.col("open"), spoil(11, nan, F.col("open")))).alias("Open"),
        spoil(13, F.col("low") / 2, F.col("high")).alias("High"), F.col("low").alias("Low"),
        spoil(17, -F.col("close"), spoil(19, nan, F.col("close"))).alias("Close"),
        F.col("adj_close").alias("Adj Close"),
        spoil(23, nan, (v % 4).cast("double")).alias("Volume"))


def _validated_bars(m: Models) -> DataFrame:
    return V.validate_bars(Ld.ingest_bars(dirty_frame(m)))


def _validated_macro(m: Models) -> DataFrame:
    day = F.dayofyear("obs_date")
    raw = m.raw_macro.select(
        F.when(day % 11 == 0, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), F.upper("series"), F.lit(" "))).alias("series"),
        F.when(day % 13 != 0, F.col("obs_date")).alias("obs_date"),
        F.when(day % 7 != 0, F.col("value")).alias("value"), "unit", "source")
    return V.validate_macro(raw)


def _validated_assets(m: Models) -> DataFrame:
    last = F.substring("symbol", -1, 1)
    return V.validate_assets(m.raw_assets.withColumns({
        "kind": F.when(last == "3", F.lit("OPCAO")).otherwise(F.col("kind")),
        "symbol": F.when(last != "5", F.col("symbol"))}))


SPARK = {
    "ingest_bars": ingest,
    "bars_zero_to_null": lambda m: Ld.ingest_bars(zero_frame(m)).select(
        "symbol", "trade_date", "open", "volume"),
    "bars_adj_fallback": lambda m: Ld.ingest_bars(api_frame(m.raw_bars, with_adj=False)).select(
        "symbol", "trade_date", "close", "adj_close"),
    "macro_json_parse": lambda m: Ld.macro_records(Ld.parse_daily_series(daily_docs(m)), "bcb"),
    "macro_unit_lookup": lambda m: Ld.unit_lookup(m.raw_macro.drop("unit")).select(
        "obs_date", "series", "unit"),
    "macro_nested_map_parse": lambda m: Ld.macro_records(
        Ld.parse_nested_series(nested_docs(m), "ipca"), "ibge", Ld.IPCA_UNIT),
    "date_formats": lambda m: m.raw_macro.select("obs_date").distinct().select(
        "obs_date", Ld.to_source_date("obs_date").alias("source_date"),
        Ld.to_period("obs_date").alias("period")),
    "asset_metadata": lambda m: Ld.asset_metadata(
        m.raw_assets.select("symbol", "name", "sector", "kind"), part_info(m)),
    "parse_symbol_list": lambda m: m.table("part").select(
        "p_partkey", F.posexplode(Ld.parse_symbol_list(
            F.regexp_replace("p_name", " ", " , "))).alias("pos", "symbol")),
    "validate_bars": lambda m: _validated_bars(m).select(
        "symbol", "trade_date", F.size("reasons").alias("n_reasons"),
        F.array_join("reasons", ",").alias("reasons"), "is_valid"),
    "validate_macro": lambda m: _validated_macro(m).select(
        "obs_date", "series", "value", "unit", "source", F.size("reasons").alias("n_reasons"),
        "is_valid"),
    "validate_assets": lambda m: _validated_assets(m).select(
        "symbol", "kind", "country", "currency", "active", F.size("reasons").alias("n_reasons"),
        "is_valid"),
    "quarantine_reasons": lambda m: V.quarantine_all([
        V.quarantine(_validated_bars(m), "bars", ["symbol", "trade_date"]),
        V.quarantine(_validated_macro(m), "macro", ["obs_date", "series"]),
        V.quarantine(_validated_assets(m), "assets", ["symbol"])]),
    "upsert_bars": lambda m: U.upsert(bar_target(m), bar_batch(m), U.BAR_KEYS, U.BAR_UPDATES),
    "upsert_macro": lambda m: U.upsert(
        m.raw_macro.where(F.col("obs_date") <= F.lit(CUT_TARGET).cast("date")),
        m.raw_macro.where(F.col("obs_date") >= F.lit(CUT_BATCH).cast("date")).select(
            "obs_date", "series", (F.col("value") * 2).alias("value"),
            F.lit("batch").alias("unit"), F.lit("manual").alias("source")),
        U.MACRO_KEYS, U.MACRO_UPDATES),
    "upsert_assets": lambda m: U.upsert(
        m.raw_assets.where(F.col("symbol") != m.params.benchmark), asset_batch(m),
        U.ASSET_KEYS, U.ASSET_UPDATES),
    "upsert_last_wins": lambda m: U.upsert_with_duplicates(
        bar_target(m), bar_batch(m, 1).unionByName(bar_batch2(m)), U.BAR_KEYS, U.BAR_UPDATES),
    "incremental_filter": lambda m: U.incremental_filter(
        bar_target(m), m.raw_bars, m.params.start_date).select("symbol", "trade_date"),
}



def _on_stored(fn):
    """Queries that read the same raw input as target and as batch run on
    inputs stored once, so the large tables are processed once."""
    def run(m: Models) -> DataFrame:
        return fn(m.stored())
    return run


for _k in ("upsert_bars", "upsert_macro", "upsert_last_wins", "incremental_filter"):
    SPARK[_k] = _on_stored(SPARK[_k])

# ---- oracle SQL -------------------------------------------------------------------------------
B = O.q(O.BENCH)


def _z(x):
    return f"nullif(coalesce({x}, 0), 0)"


_VALID_BARS_RULES = [("symbol IS NULL OR symbol = ''", "empty_symbol"),
                     ("trade_date IS NULL", "missing_date")]
for _c in V.PRICE_COLS:
    _VALID_BARS_RULES += [(f"{_c} IS NOT NULL AND isnan({_c})", f"{_c}_nan"),
                          (f"{_c} IS NOT NULL AND NOT isnan({_c}) AND {_c} <= 0", f"{_c}_not_positive")]
_VALID_BARS_RULES += [("high IS NOT NULL AND low IS NOT NULL AND NOT isnan(high) AND NOT isnan(low) "
                       "AND high < low", "high_below_low"),
                      ("volume_raw IS NOT NULL AND isnan(volume_raw)", "volume_nan")]


def _reasons_sql(rules):
    items = ", ".join(f"CASE WHEN {c} THEN {O.q(n)} END" for c, n in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


_ZERO_FRAME = f"""
  SELECT upper(trim(symbol)) AS symbol, trade_date,
    {_z('CASE WHEN volume % 5 = 0 THEN 0.0 ELSE open END')} AS open, {_z('high')} AS high,
    {_z('low')} AS low, {_z('close')} AS close, {_z('adj_close')} AS adj_close,
    CASE WHEN NOT isnan(CAST(volume % 4 AS DOUBLE)) THEN CAST({_z('CAST(volume % 4 AS DOUBLE)')} AS BIGINT) END AS volume,
    CAST(volume % 4 AS DOUBLE) AS volume_raw
  FROM raw_bars"""


def _spoil(n, bad, good):
    return f"CASE WHEN volume % {n} = 0 THEN {bad} ELSE {good} END"


_NAN = "CAST('NaN' AS DOUBLE)"
_DIRTY_OPEN = _spoil(5, "0.0", _spoil(7, "-open", _spoil(11, _NAN, "open")))
_DIRTY_FRAME = f"""
  SELECT symbol, trade_date, {_z('open')} AS open, {_z('high')} AS high, {_z('low')} AS low,
    {_z('close')} AS close, {_z('adj_close')} AS adj_close, volume AS volume_raw FROM (
    SELECT upper(trim({_spoil(29, "'  '", 'symbol')})) AS symbol,
      CASE WHEN volume % 31 <> 0 THEN trade_date END AS trade_date, {_DIRTY_OPEN} AS open,
      {_spoil(13, 'low / 2', 'high')} AS high, low,
      {_spoil(17, '-close', _spoil(19, _NAN, 'close'))} AS close, adj_close,
      {_spoil(23, _NAN, 'CAST(volume % 4 AS DOUBLE)')} AS volume FROM raw_bars) d"""
_VB = f"SELECT *, {_reasons_sql(_VALID_BARS_RULES)} AS reasons FROM ({_DIRTY_FRAME}) z"
_MACRO_RULES = [("series IS NULL OR series = ''", "empty_series"), ("value IS NULL", "missing_value"),
                ("obs_date IS NULL", "missing_date")]
_VM = (f"SELECT obs_date, series, value, coalesce(unit, '%') AS unit, coalesce(source, 'bcb') AS source, "
       f"{_reasons_sql(_MACRO_RULES)} AS reasons FROM (SELECT CASE WHEN dayofyear(obs_date) % 13 <> 0 THEN obs_date END "
       f"AS obs_date, CASE WHEN dayofyear(obs_date) % 11 = 0 THEN '' ELSE lower(trim(' ' || upper(series) || ' ')) END "
       f"AS series, CASE WHEN dayofyear(obs_date) % 7 <> 0 THEN value END AS value, unit, source FROM raw_macro) r")
_ASSET_RULES = [(f"kind IS NULL OR NOT regexp_matches(kind, {O.q(V.KIND_PATTERN)})", "bad_kind"),
                ("symbol IS NULL", "missing_symbol")]
_VA = (f"SELECT upper(trim(symbol)) AS symbol, kind, coalesce(country, 'Brasil') AS country, "
       f"coalesce(currency, 'BRL') AS currency, coalesce(active, true) AS active, "
       f"{_reasons_sql(_ASSET_RULES)} AS reasons FROM (SELECT CASE WHEN right(symbol, 1) <> '5' THEN symbol END AS symbol, "
       f"CASE WHEN right(symbol, 1) = '3' THEN 'OPCAO' ELSE kind END AS kind, country, currency, active "
       f"FROM raw_assets) a")


def _upsert_sql(t, b, keys, update_cols, all_cols):
    on = " AND ".join(f"t.{k} = b.{k}" for k in keys)
    sel = [f"coalesce(t.{k}, b.{k}) AS {k}" for k in keys]
    for c in all_cols:
        if c in update_cols:
            sel.append(f"CASE WHEN b._in THEN b.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t._in THEN t.{c} ELSE b.{c} END AS {c}")
    return (f"SELECT {', '.join(sel)} FROM (SELECT *, true AS _in FROM ({t}) t0) t "
            f"FULL OUTER JOIN (SELECT *, true AS _in FROM ({b}) b0) b ON {on}")


_BAR_COLS = ["open", "high", "low", "close", "adj_close", "volume", "source"]
_T_BARS = f"SELECT * FROM raw_bars WHERE trade_date <= DATE '{CUT_TARGET}'"
_B_BARS = (f"SELECT symbol, trade_date, open, high, low, close, adj_close * 2 AS adj_close, "
           f"CASE WHEN symbol <> {B} THEN volume END AS volume, 'b3' AS source FROM raw_bars "
           f"WHERE trade_date >= DATE '{CUT_BATCH}'")
_B2_BARS = (f"SELECT symbol, trade_date, open, high, low, close, adj_close * 4 AS adj_close, "
            f"volume, 'manual' AS source FROM raw_bars WHERE trade_date >= DATE '{CUT_SECOND}'")
_DEDUP = f"""
  SELECT symbol, trade_date, l.open, l.high, l.low, l.close, l.adj_close, l.volume, f.source FROM (
    SELECT symbol, trade_date,
      arg_max(struct_pack(open := open, high := high, low := low, close := close,
                          adj_close := adj_close, volume := volume), seq) AS l,
      arg_min(struct_pack(source := source), seq) AS f
    FROM (SELECT *, 1 AS seq FROM ({_B_BARS}) a UNION ALL SELECT *, 2 AS seq FROM ({_B2_BARS}) c) u
    GROUP BY symbol, trade_date) d"""
_ASSET_COLS = ["name", "sector", "subsector", "kind", "country", "currency", "active"]
_B_ASSETS = ("SELECT symbol, upper(coalesce(name, symbol)) AS name, lower(sector) AS sector, "
             "CAST(NULL AS VARCHAR) AS subsector, CASE WHEN kind = 'ACAO' THEN 'FII' ELSE kind END AS kind, "
             "'Portugal' AS country, 'EUR' AS currency, false AS active FROM raw_assets")
_PART_INFO = """
  SELECT symbol, symbol || ' holding ' || CAST(n AS VARCHAR) AS long_name,
    CASE WHEN n % 3 <> 0 THEN s1 END AS info_sector, s2 AS industry,
    CASE WHEN n % 2 = 0 THEN 'USD' END AS info_currency
  FROM (SELECT regexp_replace(upper(p_brand), '#', '') AS symbol, count(*) AS n,
               min(p_type) AS s1, max(p_type) AS s2 FROM part GROUP BY 1) g"""
_BCB_UNIT = O._case("series", [(k, O.q(v)) for k, v in Ld.SERIES_UNITS.items()], O.q(Ld.DEFAULT_UNIT))

SQL = {
    "ingest_bars": f"""SELECT symbol, trade_date, {_z('open')} AS open, {_z('high')} AS high,
        {_z('low')} AS low, {_z('close')} AS close, {_z('adj_close')} AS adj_close,
        CAST({_z('CAST(volume AS DOUBLE)')} AS BIGINT) AS volume, 'yahoo_finance' AS source FROM raw_bars""",
    "bars_zero_to_null": "SELECT symbol, trade_date, open, volume FROM (" + _ZERO_FRAME + ") z",
    "bars_adj_fallback": f"SELECT symbol, trade_date, {_z('close')} AS close, {_z('close')} AS adj_close FROM raw_bars",
    "macro_json_parse": f"SELECT obs_date, series, value, unit, source FROM raw_macro "
                        f"WHERE series IN ({O.inlist(St.DAILY_SERIES)})",
    "macro_unit_lookup": f"SELECT obs_date, series, {_BCB_UNIT} AS unit FROM raw_macro",
    "macro_nested_map_parse": "SELECT obs_date, series, value, unit, source FROM raw_macro WHERE series = 'ipca'",
    "date_formats": "SELECT obs_date, strftime(obs_date, '%d/%m/%Y') AS source_date, "
                    "strftime(obs_date, '%Y%m') AS period FROM (SELECT DISTINCT obs_date FROM raw_macro) d",
    "asset_metadata": f"""SELECT c.symbol, coalesce(nullif(c.name, ''), i.long_name, c.symbol) AS name,
        coalesce(nullif(c.sector, ''), i.info_sector) AS sector, i.industry AS subsector,
        coalesce(c.kind, 'ACAO') AS kind, 'Brasil' AS country, coalesce(i.info_currency, 'BRL') AS currency,
        true AS active FROM raw_assets c LEFT JOIN ({_PART_INFO}) i ON i.symbol = c.symbol""",
    "parse_symbol_list": """SELECT p_partkey, CAST(unnest(generate_series(0, len(arr) - 1)) AS INTEGER) AS pos,
        unnest(arr) AS symbol FROM (SELECT p_partkey, list_transform(string_split(
        regexp_replace(p_name, ' ', ' , ', 'g'), ','), lambda x: trim(x)) AS arr FROM part) p""",
    "validate_bars": f"SELECT symbol, trade_date, CAST(len(reasons) AS INTEGER) AS n_reasons, "
                     f"array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS is_valid FROM ({_VB}) v",
    "validate_macro": f"SELECT obs_date, series, value, unit, source, CAST(len(reasons) AS INTEGER) AS n_reasons, "
                      f"len(reasons) = 0 AS is_valid FROM ({_VM}) v",
    "validate_assets": f"SELECT symbol, kind, country, currency, active, CAST(len(reasons) AS INTEGER) AS n_reasons, "
                       f"len(reasons) = 0 AS is_valid FROM ({_VA}) v",
    "quarantine_reasons": f"""
        SELECT 'bars' AS entity, coalesce(symbol, '') || '|' || coalesce(CAST(trade_date AS VARCHAR), '') AS record_key,
          unnest(reasons) AS reason FROM ({_VB}) v WHERE len(reasons) > 0
        UNION ALL
        SELECT 'macro', coalesce(CAST(obs_date AS VARCHAR), '') || '|' || coalesce(series, ''), unnest(reasons)
        FROM ({_VM}) v WHERE len(reasons) > 0
        UNION ALL
        SELECT 'assets', coalesce(symbol, ''), unnest(reasons) FROM ({_VA}) v WHERE len(reasons) > 0""",
    # Target and batch are parts of raw_bars, whose keys are unique: the full
    # join of the two (as for upsert_last_wins) comes to one case a row.
    "upsert_bars": f"""SELECT symbol, trade_date, open, high, low, close,
        CASE WHEN in_b THEN adj_close * 2 ELSE adj_close END AS adj_close,
        CASE WHEN in_b AND symbol = {B} THEN NULL ELSE volume END AS volume,
        CASE WHEN in_t THEN source ELSE 'b3' END AS source
        FROM (SELECT *, trade_date <= DATE '{CUT_TARGET}' AS in_t, trade_date >= DATE '{CUT_BATCH}' AS in_b
              FROM raw_bars) r WHERE in_t OR in_b""",
    "upsert_macro": _upsert_sql(
        f"SELECT * FROM raw_macro WHERE obs_date <= DATE '{CUT_TARGET}'",
        f"SELECT obs_date, series, value * 2 AS value, 'batch' AS unit, 'manual' AS source "
        f"FROM raw_macro WHERE obs_date >= DATE '{CUT_BATCH}'",
        ["obs_date", "series"], U.MACRO_UPDATES, ["value", "unit", "source"]),
    "upsert_assets": _upsert_sql(f"SELECT * FROM raw_assets WHERE symbol <> {B}", _B_ASSETS, ["symbol"],
                                 U.ASSET_UPDATES, _ASSET_COLS),
    "upsert_last_wins": _upsert_sql(_T_BARS, _DEDUP, ["symbol", "trade_date"], U.BAR_UPDATES, _BAR_COLS),
    "incremental_filter": f"""SELECT b.symbol, b.trade_date FROM raw_bars b
        LEFT JOIN (SELECT symbol, max(trade_date) AS last FROM ({_T_BARS}) t GROUP BY symbol) w ON w.symbol = b.symbol
        WHERE b.trade_date >= coalesce(w.last, DATE '{O.DEFAULT_PARAMS.start_date}')""",
}
