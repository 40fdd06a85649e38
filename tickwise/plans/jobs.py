"""Batch jobs and sinks.

Tables are Parquet partitioned by year and sorted by (symbol, date) inside
each file, so date and symbol predicates skip row groups by min/max. A
rewrite replaces only the year partitions present in the new data
(dynamic partition overwrite), and the merged data is first stored in the
shared checkpoint folder (``session.stored``): the rewrite then never
reads the files it is replacing, and a lost executor re-reads the stored
files instead of replaying the whole lineage.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import quality as Qy, raw_rules as Rr, upsert as U, validate as Va
from tickwise.plans import versions as V
from tickwise.plans.check_states import CheckStates
from tickwise.plans.interleave import interleaved
from tickwise.session import scratch, stored
from tickwise.sources.landing import ingest_bars
from tickwise.sources.ledger import Ledger


def with_year(df: DataFrame, date_col: str) -> DataFrame:
    return df if "year" in df.columns else df.withColumn("year", F.year(date_col))


def layout(df: DataFrame, date_col: str = "trade_date", key_col: str | None = "symbol") -> DataFrame:
    """H5: spread by (year, key) so one heavy year still spans many tasks,
    then sort inside each file by key and date. The sort leads with the year,
    as a partitioned write asks for: Spark would else sort anew by year alone."""
    d = with_year(df, date_col)
    parts = [F.col("year")] + ([F.col(key_col)] if key_col and key_col in d.columns else [])
    sort = ([key_col] if key_col and key_col in d.columns else []) + [date_col]
    return d.repartition(*parts).sortWithinPartitions("year", *sort)


def publish(df: DataFrame, path: str, date_col: str = "trade_date",
            key_col: str | None = "symbol") -> None:
    """Write ``df`` to a year-partitioned table, replacing only its years."""
    (layout(df, date_col, key_col).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored at ``path``. Only a missing path and a folder
    without data files mean no; any other error rises, so that a failed read
    never turns an upsert into an overwrite."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def upsert_into(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                update_cols: list[str], date_col: str, merge=U.upsert,
                entity: str | None = None) -> DataFrame:
    """A16-A18 against a stored table: only the stored years the batch touches
    take part in the merge, which is stored; those years are rewritten.
    ``merge`` is ``U.merge_sequenced`` for rows that carry their sequence.
    The batch is read twice, so it is stored first; with ``entity``, that write
    counts the rows that break a raw rule (``raw_rules``), and the table stays
    as it is if there are any. Returns the merged rows."""
    if entity is None:
        batch = stored(batch, "upsert_batch")
    else:
        counted, check = Rr.observed(batch, entity)
        batch = stored(counted, "upsert_batch")
        check()
    if table_exists(spark, path):
        years = batch.select(F.year(date_col).alias("year")).distinct()
        # The distinct years of a batch are bounded by the calendar span.
        current = spark.read.parquet(path)
        target = current.join(F.broadcast(years), "year", "left_semi").drop("year")
        merged = stored(merge(target.select(*batch.columns), batch, keys, update_cols), "upsert")
    else:
        merged = batch
    publish(merged, path, date_col, keys[0] if keys[0] != date_col else None)
    return merged


def materialise(spark: SparkSession, df: DataFrame, name: str, kind: str = "table",
                date_col: str | None = "trade_date", analyze: bool = True,
                path: str | None = None, files: int | None = None) -> DataFrame:
    """H3/H4: view (temp view), inline (the DataFrame itself), table (rows in
    year partitions, sorted) or interleaved (rows in files that prune by symbol
    and by date, ``interleave``; ``df`` should be stored).

    A table's rows are written to a new folder (``path``, else one in the
    warehouse), which becomes a catalog table of its own with column
    statistics; only then is ``name``, a view, moved to it by one statement.
    A failed write leaves the earlier rows, and a reader finds the earlier
    rows or the new ones, never no table. The earlier folder is left for its
    readers and may be removed later."""
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    mark = uuid.uuid4().hex
    if not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{mark}"
    by_year = bool(date_col) and kind == "table"
    if kind == "interleaved":
        w = interleaved(df, "symbol", date_col, files).write.mode("errorifexists")
    else:
        w = (layout(df, date_col) if by_year else df).write.mode("errorifexists")
    (w.partitionBy("year") if by_year else w).parquet(path)
    version = f"{name}_{mark}"
    spark.catalog.createTable(version, path, "parquet")
    if by_year:
        spark.catalog.recoverPartitions(version)
    if analyze:
        spark.sql(f"ANALYZE TABLE {version} COMPUTE STATISTICS FOR ALL COLUMNS")
    earlier = versions_of(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in earlier - {version}:
        spark.sql(f"DROP TABLE IF EXISTS {old}")        # its name only: the folder stays
    return spark.table(name)


def versions_of(spark: SparkSession, name: str) -> set[str]:
    """The catalog tables made for ``name`` by ``materialise``."""
    return {t.name for t in spark.catalog.listTables()
            if t.name.startswith(f"{name.lower()}_") and len(t.name) == len(name) + 33}


def forget(spark: SparkSession, name: str) -> None:
    """Remove ``name`` and its tables from the catalog; folders stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for old in versions_of(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def publish_marts(spark: SparkSession, marts: dict[str, tuple[DataFrame, str | None]],
                  base: str, prefix: str = "tickwise", kind: str = "table") -> dict[str, str]:
    """H3-H5 for the fact and the marts: each (DataFrame, date column or None)
    becomes the table ``<prefix>_<name>`` stored under ``base``, with the
    load time in ``updated_at``; ``kind`` ("table" or "interleaved") is how
    those with a date are laid out. Returns the folder of each."""
    paths = {name: os.path.join(base, f"{name}-{uuid.uuid4().hex}") for name in marts}
    for name, (df, date_col) in marts.items():
        materialise(spark, df.withColumn("updated_at", F.current_timestamp()),
                    f"{prefix}_{name}", kind if date_col else "table", date_col, path=paths[name])
    return paths


def loaded(rows: DataFrame) -> DataFrame:
    """The rows with their load time; set on insert and on update."""
    return rows.withColumn("loaded_at", F.current_timestamp())


#: What tells fetches apart: their time, then their file.
SEQUENCE = "struct<t:bigint,file_path:string>"


def stored_bars(rows: DataFrame) -> DataFrame:
    """Bars as the table holds them, whoever loads it: with their load time and
    with the first and last sequence, NULL where the load gives none. A batch
    load overwrites values and leaves a stored row's sequence; a streamed row
    overwrites those of a batch, or of an older fetch."""
    for c in ("first_seq", "last_seq"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(SEQUENCE))
    return loaded(rows).select(*U.BAR_KEYS, *U.BAR_UPDATES, "source", "loaded_at", "first_seq", "last_seq")


def deduped(rows: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """A19 for a load: one row a key. ``batch_seq`` orders rows of equal keys
    (the last one's updated columns win); where the source gives none, the
    rows' own values do, so that reruns agree."""
    if "batch_seq" not in rows.columns:
        rows = rows.withColumn("batch_seq", F.struct(*[F.col(c) for c in rows.columns if c not in keys]))
    return U.dedupe_batch(rows, keys, update_cols, "batch_seq")


def bar_watermarks(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The last stored date of each symbol: from the watermark table, else
    from the stored bars; None if nothing is stored. The table is written
    after the bars, so after a failed load it may only lag behind them, and
    the rows in between are loaded again."""
    if not table_exists(spark, os.path.join(out_dir, "prices")):
        return None
    marks = os.path.join(out_dir, "watermarks")
    if table_exists(spark, marks):
        return spark.read.parquet(marks)
    # stored, as the load rewrites the files that they come from
    return stored(U.watermarks(spark.read.parquet(os.path.join(out_dir, "prices"))), "watermarks")


def run_load(spark: SparkSession, out_dir: str, bars: DataFrame, macro: DataFrame,
             assets: DataFrame, mode: str = "incremental", only: str | None = None,
             start_date: str = "2019-01-01", parse_rejects: DataFrame | None = None) -> DataFrame:
    """One load (``_load``); its intermediate copies are removed at its end."""
    with scratch(spark):
        return _load(spark, out_dir, bars, macro, assets, mode, only, start_date, parse_rejects)


def _load(spark: SparkSession, out_dir: str, bars: DataFrame, macro: DataFrame, assets: DataFrame,
          mode: str, only: str | None, start_date: str, parse_rejects: DataFrame | None) -> DataFrame:
    """Load assets, then prices, then macro (or one of them with
    ``only``). Incremental prices keep, per symbol, the rows from the last
    stored date on (that day is loaded again); macro is always a full
    reload, as in the reference. Each step validates, appends its rejects
    to a quarantine table and upserts the valid rows; ``parse_rejects``
    (``landing.macro_rejects``) join them. A step's validated input feeds
    the rejects and the load, so it is stored once. A step whose rows break a
    raw rule raises ``RawRuleError`` and leaves its table as it was; the rows
    and rules join the quarantine. Returns the row count of each stored table."""
    steps = ["assets", "prices", "macro"] if only is None else [only]
    for name in ("assets", "watermarks"):
        V.restore(spark, os.path.join(out_dir, name))
    paths = {s: os.path.join(out_dir, s) for s in ("assets", "prices", "macro", "quarantine")}
    run_id = uuid.uuid4().hex
    rejects = [] if parse_rejects is None else [parse_rejects]

    def refused(rows: DataFrame, entity: str, keys: list[str]) -> None:
        rejects.append(Rr.split(rows, entity, keys)[1])
        _append_rejects(rejects, run_id, paths["quarantine"])

    for step in steps:
        if step == "assets":
            v = stored(Va.validate_assets(assets), "validated_assets")
            rejects.append(Va.quarantine(v, "assets", ["symbol"]))
            new = loaded(deduped(Va.valid_rows(v), U.ASSET_KEYS, U.ASSET_UPDATES))
            good = new
            if table_exists(spark, paths["assets"]):
                current = spark.read.parquet(paths["assets"])
                good = U.upsert(current.select(*good.columns), good, U.ASSET_KEYS,
                                U.ASSET_UPDATES + ["loaded_at"])
            good, check = Rr.observed(good, "assets")
            try:
                V.replace(good, paths["assets"], check)
            except Rr.RawRuleError:
                refused(new, "assets", U.ASSET_KEYS)
                raise
        elif step == "prices":
            v = stored(Va.validate_bars(bars), "validated_bars")
            rejects.append(Va.quarantine(v, "bars", ["symbol", "trade_date"]))
            good = deduped(Va.valid_rows(v).drop("volume_raw"), U.BAR_KEYS, U.BAR_UPDATES)
            marks = bar_watermarks(spark, out_dir)
            if mode == "incremental" and marks is not None:
                good = U.since_watermark(marks, good, start_date)
            try:
                merged = U.watermarks(upsert_into(spark, paths["prices"], stored_bars(good), U.BAR_KEYS,
                                                  U.BAR_UPDATES + ["loaded_at"], "trade_date", entity="bars"))
            except Rr.RawRuleError:
                refused(good, "bars", U.BAR_KEYS)
                raise
            if marks is not None:
                merged = U.watermarks(marks.unionByName(merged), date_col="last_date")
            V.replace(merged, os.path.join(out_dir, "watermarks"))
        elif step == "macro":
            v = stored(Va.validate_macro(macro), "validated_macro")
            rejects.append(Va.quarantine(v, "macro", ["obs_date", "series"]))
            good = deduped(Va.valid_rows(v), U.MACRO_KEYS, U.MACRO_UPDATES)
            try:
                upsert_into(spark, paths["macro"], loaded(good), U.MACRO_KEYS,
                            U.MACRO_UPDATES + ["loaded_at"], "obs_date", entity="macro")
            except Rr.RawRuleError:
                refused(good, "macro", U.MACRO_KEYS)
                raise
        else:
            raise ValueError(f"unknown step {step!r}")
    if rejects:
        _append_rejects(rejects, run_id, paths["quarantine"])
    counts = [spark.read.parquet(paths[s]).select(F.lit(s).alias("table_name"),
                                                   F.count(F.lit(1)).alias("rows"))
              for s in ("assets", "prices", "macro") if table_exists(spark, paths[s])]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _append_rejects(rejects: list[DataFrame], run_id: str, path: str) -> None:
    Va.quarantine_all(rejects).withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)


def load_landed(spark: SparkSession, out_dir: str, landing: str, macro: DataFrame, assets: DataFrame,
                attempts: int = 3, **options) -> DataFrame:
    """A21 from landed Parquet files: the pending ones are taken by the ledger
    below ``out_dir``, batch by batch; a batch is loaded (``run_load`` with
    ``options``), its newly quarantined files join the quarantine, and only
    then does the ledger say so. Loads are idempotent, so a batch that fails on
    the way is taken again. Returns the verdicts of all files."""
    ledger = Ledger(spark, os.path.join(out_dir, "ledger"), attempts)
    with scratch(spark):
        for taken in ledger.take(landing):
            aside = taken.files.where("verdict = 'quarantined'").select(
                F.lit("bars").alias("entity"), F.col("file").alias("record_key"), "reason")
            _load(spark, out_dir, ingest_bars(taken.rows), macro, assets, options.get("mode", "incremental"),
                  options.get("only"), options.get("start_date", "2019-01-01"), aside)
            ledger.commit(taken)
    return ledger.entries()


def store_quality_results(results: DataFrame, path: str, run_id: str | None = None) -> str:
    """X11: append a checkpoint's result rows to a Parquet table keyed by run
    id (one partition per run), so earlier runs are never rewritten."""
    rid = run_id or uuid.uuid4().hex
    (results.withColumn("run_id", F.lit(rid)).withColumn("run_at", F.current_timestamp())
            .write.mode("append").partitionBy("run_id").parquet(path))
    return rid


def run_checkpoint(spark: SparkSession, base: str, suites: dict[str, tuple[DataFrame, str]],
                   years: list[int] | None = None, run_id: str | None = None) -> DataFrame:
    """X11 over a history: each suite's (table, date column) brings the states
    of ``years`` up to date (None: of all), and the results of the whole tables
    join the earlier runs' below ``base``. Returns those of this run."""
    results = []
    for suite, (table, date_col) in suites.items():
        states = CheckStates(spark, f"{base}/{suite}", date_col, [e for e in Qy.EXPECTATIONS if e.suite == suite])
        states.update(table, years)
        results.append(states.expectation_results())
    rid = store_quality_results(reduce(DataFrame.unionByName, results), f"{base}/results", run_id)
    return quality_history(spark, base).where(F.col("run_id") == rid)


def quality_history(spark: SparkSession, base: str) -> DataFrame:
    """The results of every checkpoint run below ``base``, with run id and time."""
    return spark.read.parquet(f"{base}/results")
