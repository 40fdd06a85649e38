"""Helpers shared by the operators: Arrow text maps, splits, checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ARROW_ROWS = 1000           # rows per Arrow batch: some MB of ordinary texts
BROADCAST_ROWS = 1_000_000  # most rows of two narrow columns sent to every executor


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches that carry texts (the default is 10,000 rows)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of the driver's ``rows``, handed over as Arrow: rows of plain
    Python go through Python workers of their own, which then stay beside
    those of the operators in each executor's memory."""
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) or [()] * len(arrow)
    return spark.createDataFrame(
        pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), fields)


def remainder_is(id_col: str, mod: int, rem: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``rem`` (null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rem, F.lit(False))


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer form of it that no column has yet."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[tuple[str, str]],
              make: Callable[[], Callable[[list], Iterable[list]]], binary: bool = False) -> DataFrame:
    """Add columns computed from whole texts, a batch at a time.

    ``make()`` runs once per task and returns a function from a list of
    texts (``None`` for null; UTF-8 bytes if ``binary``) to one list per
    output field. The result has the columns ``keep``, then ``fields``.
    """
    arrow_batches(df.sparkSession)
    kept = [f for name in keep for f in df.schema.fields if f.name == name]
    new = [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]
    schema = T.StructType(kept + new)
    out_types = [f.type for f in to_arrow_schema(T.StructType(new))]
    col = fresh(keep, "_text")
    names = [f.name for f in schema.fields]
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()

        def added(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(n_keep)
            texts = (texts.cast(pa.binary()) if binary else texts).to_pylist()
            out = [pa.array(v, t) for v, t in zip(f(texts), out_types)]
            return pa.RecordBatch.from_arrays([b.column(i) for i in range(n_keep)] + out, names)

        yield from map(added, batches)
        # A worker that waits for its next task gives the freed batches back.
        pa.default_memory_pool().release_unused()

    picked = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(col))
    return picked.mapInArrow(run, schema)


def join_checked(big: DataFrame, small: DataFrame, key: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join on ``key``; ``small`` (narrow, unique by ``key``) goes to
    every executor only if a count shows at most ``rows`` rows, beyond that
    both sides are shuffled."""
    if small.count() <= rows:
        small = F.broadcast(small)
    return big.join(small, key)


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """One row per labelled document: doc_id, y (0 or 1). Ids or labels that
    are null and documents whose rows contradict each other are left out."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
            .groupBy("doc_id").agg(F.min(column).alias("y"), F.max(column).alias("_hi"))
            .where("y = _hi").select("doc_id", F.col("y").cast("int").alias("y")))
