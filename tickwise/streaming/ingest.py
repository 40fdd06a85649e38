"""Continuous ingest of landed price files.

A file stream (JSON lines, PERMISSIVE with ``_corrupt_record``) feeds
``foreachBatch``: corrupt lines go to a quarantine table, the rest are
normalised (A1-A3), validated (A12), de-duplicated by an explicit sequence
(A19: last value wins, first source stays) and merged into the stored
table (A16) by rewriting only the years they touch. That table may be the one
that batch loads write (``jobs.stored_bars``), in any order. It keeps the
first and last sequence of each row, so an older fetch that lands later
does not undo a newer one, however the files are cut into micro-batches.
The merge is idempotent, so a micro-batch replayed after a failure leaves
the same table. Late corrections are ordinary updates: no watermark drops
them.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators import raw_rules as Rr, upsert as U, validate as V
from tickwise.plans.jobs import stored_bars, upsert_into
from tickwise.session import checkpoint_dir, scratch
from tickwise.sources import landing as Ld

STREAM_SCHEMA = T.StructType(Ld.LANDED_BAR_SCHEMA.fields + [
    T.StructField("fetched_at", T.LongType()),
    T.StructField("_corrupt_record", T.StringType())])


def landed_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(STREAM_SCHEMA).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt_record")
                 .option("maxFilesPerTrigger", files_per_trigger).json(landing)
                 .select("*", F.col("_metadata.file_path").alias("file_path")))


def process_batch(spark: SparkSession, target: str, quarantine: str):
    """The micro-batch function: quarantine, validate, dedupe, upsert. Rows
    that break a raw rule are set aside one by one.

    The batch is read by several actions, so it is persisted for the
    duration of the call (a lost block is recomputed from the batch's own
    files). Rejects are written to the epoch's own partition with dynamic
    overwrite, and the upsert is idempotent, so replaying an epoch after a
    failure leaves both tables as a single run would."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            corrupt = batch.where(F.col("_corrupt_record").isNotNull())
            ok = batch.where(F.col("_corrupt_record").isNull())
            # Later fetch wins; the file path breaks ties deterministically.
            seq = F.struct(F.coalesce(F.col("fetched_at"), F.lit(0)).alias("t"), F.col("file_path"))
            frame = ok.withColumn("batch_seq", seq).drop("fetched_at", "file_path", "_corrupt_record")
            v = V.validate_bars(Ld.ingest_bars(frame, keep=("batch_seq",)))
            good, aside = Rr.split(V.valid_rows(v).drop("volume_raw"), "bars", U.BAR_KEYS)
            rejects = (corrupt.select(F.lit("bars").alias("entity"),
                                      F.col("file_path").alias("record_key"),
                                      F.lit("corrupt_record").alias("reason"))
                       .unionByName(V.quarantine(v, "bars", ["symbol", "trade_date"])).unionByName(aside))
            (rejects.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic").partitionBy("epoch")
                    .parquet(quarantine))
            good = U.settle_sequenced(stored_bars(U.sequenced(good)), U.BAR_KEYS, U.BAR_UPDATES)
            with scratch(spark):
                upsert_into(spark, target, good, U.BAR_KEYS, U.BAR_UPDATES, "trade_date",
                            merge=U.merge_sequenced)
        finally:
            batch.unpersist()
    return fn


def run_stream_ingest(spark: SparkSession, landing: str, target: str,
                      checkpoint: str | None = None, every: str | None = None,
                      files_per_trigger: int = 1000):
    """Process every landed file available now and stop (scheduled runs), or
    with ``every`` (e.g. '5 minutes') keep running and return the query.
    ``files_per_trigger`` sizes a micro-batch; it does not change the table."""
    ck = checkpoint or os.path.join(checkpoint_dir(spark), "stream_ingest")
    quarantine = target.rstrip("/") + "_quarantine"
    w = (landed_stream(spark, landing, files_per_trigger).writeStream
         .foreachBatch(process_batch(spark, target, quarantine))
         .option("checkpointLocation", ck))
    if every:
        return w.trigger(processingTime=every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
