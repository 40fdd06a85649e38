"""The ledger of landed files (A10, A21): what was read, is waiting, or was set aside.

One table says of each landed file, told apart by path, length and time of
change: the rows its footer counts, the rows that could be read, and a
verdict. ``loaded``: all its rows were read. ``waiting``: rows were missing,
as after a read error that may pass; it is tried again by the next load.
``quarantined``: it fell short in ``attempts`` loads. So at any time

    landed files = loaded + waiting + quarantined + not yet seen

and the rows handed out are exactly those of the loaded ones. Files are read
once: a load copies their rows to the shared folder and counts them there,
and what it hands out is that copy, so no second read can disagree. A file
that fell short is read once more before the load gives a verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.plans.versions import exists
from tickwise.session import stored
from tickwise.sources.landing import LANDED_BAR_SCHEMA

COLUMNS = ("file string, path string, length bigint, modified timestamp, rows_footer bigint, rows_read bigint, "
           "tries int, verdict string, reason string")
KEY = ("file", "length", "modified")


@dataclass
class Taken:
    """A batch of files: the rows of those that were read whole, with the file
    of each as ``landed_file``, and a ledger row for every file."""
    rows: DataFrame
    files: DataFrame


class Ledger:
    def __init__(self, spark: SparkSession, path: str, attempts: int = 3, batch_files: int = 10_000):
        self.spark, self.path, self.attempts, self.batch_files = spark, path, attempts, batch_files

    def entries(self) -> DataFrame:
        """The last row of each file's version."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], COLUMNS)
        last = Window.partitionBy(*KEY).orderBy(F.desc("tries"))
        log = self.spark.read.schema(COLUMNS).parquet(self.path)
        return log.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def pending(self, landing: str) -> DataFrame:
        """(file, path, length, modified, tries) of the landed files without a
        final verdict: new ones, changed ones and those that wait."""
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
                  .select(F.col("_metadata.file_path").alias("file"), "path", "length",
                          F.col("modificationTime").alias("modified")))
        known = self.entries()
        waiting = known.where("verdict = 'waiting'").select(*KEY, F.col("tries"))
        final = known.where("verdict <> 'waiting'").select(*KEY)
        return (listed.join(final, list(KEY), "left_anti").join(waiting, list(KEY), "left")
                .select("file", "path", "length", "modified", F.coalesce("tries", F.lit(0)).alias("tries")))

    def _stage(self, paths: list[str], landing: str, schema: T.StructType) -> DataFrame:
        """One read of these files: their rows, as far as they go, stored."""
        lax = self.spark.read.schema(schema).option("basePath", landing).option("ignoreCorruptFiles", "true")
        df = lax.parquet(*paths)
        return stored(df.select("*", F.col("_metadata.file_path").alias("landed_file")), "landed")

    def _footers(self, paths: list[str]) -> DataFrame:
        """Rows by footer; without columns Spark reads nothing else."""
        lax = self.spark.read.schema("_none int").option("ignoreCorruptFiles", "true").parquet(*paths)
        return lax.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows_footer"))

    def take(self, landing: str, schema: T.StructType = LANDED_BAR_SCHEMA) -> Iterator[Taken]:
        """The pending files, in batches that the driver can list, the oldest
        first. ``commit`` a batch when its rows are where they belong; until
        then it is pending, so a load that fails is repeated whole."""
        pending = stored(self.pending(landing), "pending")
        order = pending.orderBy("modified", "file")
        done = 0
        while batch := order.offset(done).limit(self.batch_files).collect():
            done += len(batch)
            yield self._read(batch, landing, schema)

    def _read(self, batch: list, landing: str, schema: T.StructType) -> Taken:
        files = stored(self.spark.createDataFrame(batch, "file string, path string, length bigint, modified timestamp, tries int"),
                       "batch")
        paths = [r.path for r in batch]
        counted, parts = None, []
        for again in range(2):
            part = self._stage(paths, landing, schema)
            seen = part.groupBy(F.col("landed_file").alias("file")).agg(F.count(F.lit(1)).alias("rows_read"))
            found = stored(files.where(F.col("path").isin(paths) if again else F.lit(True))
                           .join(self._footers(paths), "file", "left").join(seen, "file", "left")
                           .na.fill(0, ["rows_footer", "rows_read"]), "counted")
            whole = found.where("rows_footer > 0 AND rows_read = rows_footer")
            parts.append(part.join(whole.select(F.col("file").alias("landed_file")), "landed_file", "left_semi"))
            counted = whole if counted is None else counted.unionByName(whole)
            short = found.where("rows_footer = 0 OR rows_read <> rows_footer")
            paths = [r.path for r in short.select("path").collect()]
            if not paths:
                break
        judged = counted.withColumn("verdict", F.lit("loaded")).withColumn("reason", F.lit(None).cast("string"))
        if paths:
            judged = judged.unionByName(short.withColumn(
                "verdict", F.when(F.col("tries") + 1 >= self.attempts, "quarantined").otherwise("waiting")).withColumn(
                "reason", F.when(F.col("rows_footer") == 0, "no_rows").otherwise("rows_lost")))
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        judged = stored(judged.withColumn("tries", F.col("tries") + 1).select(*names), "judged")
        return Taken(reduce(DataFrame.unionByName, parts), judged)

    def commit(self, taken: Taken) -> None:
        """Set down a batch's verdicts, by one append."""
        taken.files.coalesce(1).write.mode("append").parquet(self.path)

    def quarantine(self) -> DataFrame:
        """entity, record_key and reason of the files set aside for good."""
        return self.entries().where("verdict = 'quarantined'").select(
            F.lit("bars").alias("entity"), F.col("file").alias("record_key"), "reason")
