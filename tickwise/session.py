"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings that every job relies on; a cluster may add more, never fewer.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "tickwise", checkpoint: str | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    # Small local inputs: let AQE keep small CPU-heavy window stages on
    # several cores instead of coalescing them to one or two tasks.
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
          .config("spark.driver.memory", "16g"))
    spark = b.getOrCreate()
    if checkpoint and not spark.conf.get("spark.checkpoint.dir", None):
        # Our own folder only where the environment names none (tests); a
        # core setting, so the session is rebuilt with it.
        spark.stop()
        spark = b.config("spark.checkpoint.dir", checkpoint).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Jobs cut lineage, stage rewrites and keep streaming state only there.
    When a local session names none, a folder inside its warehouse is used;
    on a cluster the setting is needed, as a warehouse may be a local folder.
    Only session configuration is read, so this works on any session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tickwise_checkpoints"
    return d.rstrip("/")


_scratch: ContextVar[list[str] | None] = ContextVar("_scratch", default=None)


def folder(spark: SparkSession, path: str):
    """A folder's file system and its path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside is removed at the end, also after an
    error: for jobs that write their results elsewhere."""
    token = _scratch.set([])
    try:
        yield
    finally:
        for path in _scratch.get():
            fs, at = folder(spark, path)
            fs.delete(at, True)
        _scratch.reset(token)


def stored(df, name: str = "table"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    Unlike an eager ``DataFrame.checkpoint()``, which computes its input once
    to count and again to save, this computes it once; the result carries
    file statistics (AQE and broadcast decisions), column pruning and
    filter pushdown. A lost executor re-reads the files instead of
    replaying the lineage. The copy is removed when the enclosing ``scratch``
    ends, else when the application does (results built on it are lazy).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tickwise_stored/{name}-{uuid.uuid4().hex}"
    paths = _scratch.get()
    if paths is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    if paths is None:
        fs, at = folder(spark, path)
        fs.deleteOnExit(at)
    return spark.read.parquet(path)
