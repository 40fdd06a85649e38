"""Queries for the operators with side effects: they write to a fresh folder
under the shared checkpoint directory and return what was stored."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import quality as Qy
from tickwise.operators.raw_rules import RawRuleError
from tickwise.plans import ingest_queries as Iq
from tickwise.plans import jobs as J
from tickwise.plans import oracle as O
from tickwise.plans.context import Models
from tickwise.plans.refresh import Store
from tickwise.session import checkpoint_dir, folder, stored
from tickwise.sources import landing as Ld
from tickwise.sources.ledger import Ledger
from tickwise.streaming import ingest as SI


def _scratch(m: Models, name: str) -> str:
    """A new folder, removed when the application ends."""
    path = os.path.join(checkpoint_dir(m.spark), "tickwise_runs", f"{name}-{uuid.uuid4().hex}")
    fs, at = folder(m.spark, path)
    fs.deleteOnExit(at)
    return path


def _land_json(frame: DataFrame, path: str) -> None:
    """Land one JSON-lines folder per symbol, as per-symbol fetches would."""
    frame.write.mode("overwrite").partitionBy("sym").json(path)


def corrupt_file_quarantine(m: Models) -> DataFrame:
    """A10: landed files with malformed lines (those of days whose volume is a
    multiple of 13 are cut short) read in one PERMISSIVE pass: each file's
    good rows are kept, bad lines are counted, no file stops another. The good
    rows are landed once more as Parquet with a damaged file beside them in
    each folder; those that the Parquet read gives are counted, and the
    damaged files must all be in the stored quarantine. One result row per
    landing folder (symbol)."""
    d = _scratch(m, "landing")
    api = Iq.api_frame(m.raw_bars)
    lines = api.select(F.col("symbol").alias("sym"), F.to_json(F.struct(*api.columns)).alias("value"),
                       F.col("Volume"))
    cut = F.when(F.col("Volume") % 13 == 0, F.substring("value", 1, 25)).otherwise(F.col("value"))
    lines.select("sym", cut.alias("value")).write.partitionBy("sym").text(d)
    df = Ld.read_landed_bars(m.spark, d, "json")
    # The record's own columns are read too: a scan of the corrupt-record
    # column alone is refused by Spark (it would skip full parsing).
    # One row per landing folder (per symbol), whatever the number of files.
    corrupt = F.col("_corrupt_record").isNotNull() | F.col("symbol").isNull()
    bad = (df.select("sym", corrupt.alias("corrupt")).groupBy("sym")
             .agg(F.count_if(F.col("corrupt")).alias("rows_corrupt")))
    p = _scratch(m, "landing_parquet")
    df.where(~corrupt).drop("_corrupt_record").write.partitionBy("sym").parquet(p)
    folders = bad.select("sym", F.lit("PAR1 cut short").alias("value"))
    folders.coalesce(1).write.mode("append").partitionBy("sym").text(p)
    q = _scratch(m, "quarantine")
    Ld.damaged_files(m.spark, p).write.parquet(q)
    lost, planted = m.spark.read.parquet(q).count(), folders.count()
    if lost != planted:
        raise ValueError(f"{lost} files in the quarantine, but {planted} damaged ones landed")
    ok = Ld.read_landed_bars(m.spark, p).groupBy("sym").agg(F.count(F.lit(1)).alias("rows_ok"))
    return (bad.join(ok, "sym", "left")
               .select(F.col("sym").alias("landing_symbol"),
                       F.coalesce("rows_ok", F.lit(0)).cast("bigint").alias("rows_ok"), "rows_corrupt"))


def ingest_modes(m: Models) -> DataFrame:
    """A full load, then an incremental load of the same inputs; the
    stored row counts must not change (the reload is idempotent)."""
    d = _scratch(m, "load")
    bars = Ld.ingest_bars(Iq.api_frame(m.raw_bars))
    J.run_load(m.spark, d, bars, m.raw_macro, m.raw_assets, mode="full")
    return J.run_load(m.spark, d, bars, m.raw_macro, m.raw_assets, mode="incremental",
                          start_date=m.params.start_date)


def raw_rules(m: Models) -> DataFrame:
    """A load, then one with texts too long and prices too large: it is
    refused, the stored rows stay. One row a broken rule with its rows, and one
    with the rows stored afterwards."""
    d = _scratch(m, "rules")
    bars, macro = Ld.ingest_bars(Iq.api_frame(m.raw_bars)), m.raw_macro
    J.run_load(m.spark, d, bars, macro, m.raw_assets, mode="full")
    bad = bars.withColumn("adj_close", F.col("adj_close") * F.when(F.col("volume") % 13 == 0, 1e12).otherwise(1.0))
    longer = F.when(F.col("symbol").endswith("5"), F.rpad("symbol", 30, "Z")).otherwise(F.col("symbol"))
    counts = {}
    for rows, step in ((bad.withColumn("symbol", longer), "prices"),
                       (macro.withColumn("unit", F.repeat("unit", 21)), "macro")):
        try:
            J.run_load(m.spark, d, rows, rows, m.raw_assets, mode="full", only=step)
        except RawRuleError as e:
            counts |= {f"{e.entity}: {rule}": n for rule, n in e.counts.items()}
    kept = [m.spark.read.parquet(os.path.join(d, s)).select(F.lit(f"{s} stored").alias("rule"),
                                                              F.count(F.lit(1)).alias("rows")) for s in ("prices", "macro")]
    return reduce(DataFrame.unionByName, kept, m.spark.createDataFrame(list(counts.items()), "rule string, rows bigint"))


def stream_ingest(m: Models) -> DataFrame:
    """Two landed fetches (the second re-sends later days with other
    prices) processed by the file stream; returns the stored table."""
    d = _scratch(m, "stream")
    api = Iq.api_frame(m.raw_bars).withColumn("sym", F.col("symbol"))
    _land_json(api.withColumn("fetched_at", F.lit(1)), os.path.join(d, "landing", "fetch1"))
    second = (api.where(F.col("Date") >= F.lit(Iq.CUT_SECOND).cast("date"))
                 .withColumn("Adj Close", F.col("Adj Close") * 4).withColumn("fetched_at", F.lit(2)))
    _land_json(second, os.path.join(d, "landing", "fetch2"))
    target = os.path.join(d, "bars")
    SI.run_stream_ingest(m.spark, os.path.join(d, "landing", "*", "*"), target,
                         os.path.join(d, "checkpoint"))
    return m.spark.read.parquet(target).drop("first_seq", "last_seq", "loaded_at")


def sink_tables(m: Models) -> DataFrame:
    """H3-H5: the fact and the three marts published as catalog tables; returns
    rows per table and year (NULL for the dimension)."""
    st, prefix = m.stored(), f"tickwise_{uuid.uuid4().hex}"
    marts = {"price_fact": (st.fact, "trade_date"), "asset_dim": (st.asset_dim, None),
             "risk_mart": (st.risk_mart, None), "correlation_mart": (st.correlation_mart, None)}
    paths = J.publish_marts(m.spark, marts, _scratch(m, "marts"), prefix)
    parts = []
    for name, path in paths.items():
        t = m.spark.read.parquet(path)
        year = F.col("year") if "year" in t.columns else F.lit(None).cast("int")
        parts.append(t.select(F.lit(name).alias("table_name"), year.alias("year"))
                      .groupBy("table_name", "year").agg(F.count(F.lit(1)).alias("rows")))
        J.forget(m.spark, f"{prefix}_{name}")           # the name of this run only
    return reduce(DataFrame.unionByName, parts)


def interleaved_lookups(m: Models) -> DataFrame:
    """H5: the fact published in files that prune by symbol and by date; the
    rows of its first symbol and those of its last date, each by a filter on
    the published table."""
    fact, name = stored(m.fact, "price_fact"), f"tickwise_{uuid.uuid4().hex}"
    J.materialise(m.spark, fact, name, "interleaved", path=_scratch(m, "interleaved"), files=64)
    ends = fact.agg(F.min("symbol").alias("symbol"), F.max("trade_date").alias("trade_date")).first()
    t = m.spark.table(name).select("symbol", "trade_date", "adj_close", "simple_return", "beta")
    return (t.where(F.col("symbol") == F.lit(ends.symbol)).withColumn("lookup", F.lit("symbol"))
             .unionByName(t.where(F.col("trade_date") == F.lit(ends.trade_date)).withColumn("lookup", F.lit("date"))))


def checkpoint_history(m: Models) -> DataFrame:
    """X11 over a history: a checkpoint of both suites without their last year,
    then one that reads that year alone; the results of the second."""
    bars, macro = stored(m.raw_bars, "bars"), stored(m.raw_macro, "macro")
    d = _scratch(m, "checkpoint")
    ends = [t.agg(F.year(F.max(c)).alias("y")).first().y for t, c in ((bars, "trade_date"), (macro, "obs_date"))]
    last = sorted({y for y in ends if y})
    early = {Qy.BAR_SUITE: (bars.where(~F.year("trade_date").isin(last)), "trade_date"),
             Qy.MACRO_SUITE: (macro.where(~F.year("obs_date").isin(last)), "obs_date")}
    J.run_checkpoint(m.spark, d, early)
    return J.run_checkpoint(m.spark, d, {Qy.BAR_SUITE: (bars, "trade_date"), Qy.MACRO_SUITE: (macro, "obs_date")},
                            last).drop("run_id", "run_at")


def _refreshed(m: Models) -> Store:
    """A store built from the bars and macro values up to one date, then
    refreshed twice: a year later, 30 days short of which is settled, and with
    all the rest."""
    bars, macro = stored(m.stg_bars, "bars"), stored(m.stg_macro, "macro")
    first, last = bars.agg(F.min("trade_date"), F.max("trade_date")).first()
    store = Store(m.spark, _scratch(m, "store"), m.params)
    middle = first + (last - first) / 2 if first else None
    for until, settle in ((middle, 0), (middle + dt.timedelta(days=365), 30), (last, 0)) if first else ():
        store.refresh(bars.where(F.col("trade_date") <= F.lit(until)), macro.where(F.col("obs_date") <= F.lit(until)), settle)
    return store


def refresh_fact(m: Models) -> DataFrame:
    """A20 carried to D12: the fact, refreshed from new days."""
    return _refreshed(m).fact()


def refresh_marts(m: Models) -> DataFrame:
    """A20 carried to F15 and E5: the risk mart and the asset dimension after
    refreshes, as rows of one table."""
    store = _refreshed(m)
    dim = store.asset_dim(m.stg_assets).select(
        "symbol", F.lit(None).cast("int").alias("year"), F.col("sessions").alias("sessions"),
        F.col("cum_return_total").alias("a"), F.col("current_vol").alias("b"), F.col("avg_price").alias("c"),
        F.col("risk_profile").alias("class"))
    risk = store.risk_mart().select(
        "symbol", "year", "sessions", F.col("annual_return_pct").alias("a"), F.col("max_drawdown_pct").alias("b"),
        F.col("sharpe").alias("c"), F.col("sharpe_class").alias("class"))
    return dim.unionByName(risk)


def landed_ledger(m: Models) -> DataFrame:
    """The bars land as Parquet by symbol, half of the symbols first,
    with a damaged file beside each; the ledger takes what is pending after
    each of two landings and once more. One row a symbol: the rows handed out,
    its files that were loaded, and those set aside."""
    landing, ledger = _scratch(m, "landing"), Ledger(m.spark, _scratch(m, "ledger") + "/files", attempts=2)
    api = stored(Iq.api_frame(m.raw_bars).withColumn("sym", F.col("symbol")), "api")
    later = F.pmod(F.xxhash64("sym"), F.lit(2)) == 1
    counts = []
    for part in (api.where(~later), api.where(later), None):
        if part is not None:
            part.repartition("sym").write.mode("append").partitionBy("sym").parquet(landing)
            (part.select("sym", F.lit("PAR1 cut short").alias("value")).distinct().coalesce(1)
                 .write.mode("append").partitionBy("sym").text(landing))
        for taken in ledger.take(landing):
            counts.append(stored(taken.rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")), "taken"))
            ledger.commit(taken)
    files = ledger.entries().groupBy(F.regexp_extract("path", "sym=([^/]*)/", 1).alias("folder")).agg(
        F.count_if(F.col("verdict") == "loaded").alias("files_loaded"),
        F.count_if(F.col("verdict") == "quarantined").alias("files_aside"))
    rows = reduce(DataFrame.unionByName, counts).groupBy("symbol").agg(F.sum("rows").alias("rows_read"))
    same = F.regexp_replace("folder", "%5E", "^") == F.col("symbol")
    return rows.join(files, same).select("symbol", "rows_read", (F.col("files_loaded") > 0).alias("loaded"), "files_aside")


SPARK = {
    "checkpoint_history": checkpoint_history,
    "interleaved_lookups": interleaved_lookups,
    "landed_ledger": landed_ledger,
    "refresh_fact": refresh_fact,
    "refresh_marts": refresh_marts,
    "corrupt_file_quarantine": corrupt_file_quarantine,
    "ingest_modes": ingest_modes,
    "raw_rules": raw_rules,
    "stream_ingest": stream_ingest,
    "sink_tables": sink_tables,
}

# ---- oracle SQL -------------------------------------------------------------------------------
_z = Iq._z
_COLS = "symbol, trade_date, adj_close, simple_return, beta"
SQL = {
    "checkpoint_history": O.expectations_sql(Qy.EXPECTATIONS, Qy.EXPECTATIONS),
    "interleaved_lookups": f"""SELECT {_COLS}, 'symbol' AS lookup FROM price_fact
        WHERE symbol = (SELECT min(symbol) FROM price_fact)
        UNION ALL SELECT {_COLS}, 'date' FROM price_fact WHERE trade_date = (SELECT max(trade_date) FROM price_fact)""",
    "landed_ledger": """SELECT symbol, count(*) AS rows_read, true AS loaded, CAST(1 AS BIGINT) AS files_aside
        FROM raw_bars GROUP BY symbol""",
    "refresh_fact": "SELECT * FROM price_fact",
    "refresh_marts": """SELECT symbol, CAST(NULL AS INTEGER) AS year, sessions, cum_return_total AS a,
        current_vol AS b, avg_price AS c, risk_profile AS class FROM asset_dim
        UNION ALL SELECT symbol, CAST(year AS INTEGER), sessions, annual_return_pct, max_drawdown_pct, sharpe,
        sharpe_class FROM risk_mart""",
    "corrupt_file_quarantine": """SELECT symbol AS landing_symbol,
        count(*) FILTER (WHERE volume IS NULL OR volume % 13 <> 0) AS rows_ok,
        count(*) FILTER (WHERE volume % 13 = 0) AS rows_corrupt FROM raw_bars GROUP BY symbol""",
    "ingest_modes": """SELECT 'assets' AS table_name, count(*) AS rows FROM raw_assets
        UNION ALL SELECT 'prices', count(*) FROM raw_bars UNION ALL SELECT 'macro', count(*) FROM raw_macro""",
    "raw_rules": """SELECT * FROM (
        SELECT 'bars: symbol takes at most 20 characters' AS rule, count(*) AS rows FROM raw_bars WHERE symbol LIKE '%5'
        UNION ALL SELECT 'bars: adj_close takes at most 12 digits before the point', count(*) FROM raw_bars
        WHERE volume % 13 = 0 AND adj_close >= 1
        UNION ALL SELECT 'macro: unit takes at most 20 characters', count(*) FROM raw_macro WHERE length(unit) > 0)
        WHERE rows > 0
        UNION ALL SELECT 'prices stored', count(*) FROM raw_bars UNION ALL SELECT 'macro stored', count(*) FROM raw_macro""",
    "stream_ingest": f"""SELECT symbol, trade_date, {_z('open')} AS open, {_z('high')} AS high,
        {_z('low')} AS low, {_z('close')} AS close,
        {_z('adj_close')} * CASE WHEN trade_date >= DATE '{Iq.CUT_SECOND}' THEN 4 ELSE 1 END AS adj_close,
        CAST({_z('CAST(volume AS DOUBLE)')} AS BIGINT) AS volume, 'yahoo_finance' AS source,
        CAST(year(trade_date) AS INTEGER) AS year FROM raw_bars""",
    "sink_tables": """SELECT 'price_fact' AS table_name, CAST(year(trade_date) AS INTEGER) AS year,
        count(*) AS rows FROM price_fact GROUP BY 2
        UNION ALL SELECT 'asset_dim', CAST(NULL AS INTEGER), count(*) FROM asset_dim
        UNION ALL SELECT 'risk_mart', CAST(year AS INTEGER), count(*) FROM risk_mart GROUP BY 2
        UNION ALL SELECT 'correlation_mart', CAST(year AS INTEGER), count(*) FROM correlation_mart GROUP BY 2""",
}
