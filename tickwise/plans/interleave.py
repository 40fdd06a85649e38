"""H5: a layout in which a lookup by symbol and one by date both skip most files.

Sorting by (symbol, date) serves a lookup by symbol; one by date then meets
every file. Here each row gets a place on either axis, the share of all rows
that come before its symbol and before its date, and rows are ordered by the
interleaved bits of both places. A file then spans a small range of symbols
and a small range of dates, and of F files a lookup on either axis meets about
the square root of F by their min/max.

Places are counted in rows, so axes are cut evenly however uneven the symbols
are; rows are cut to files by range over (place, symbol, date), so a symbol
that holds a third of all rows is spread over a third of the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.session import stored

BITS = 16                       # places on an axis: 2 ** BITS
ROWS_PER_FILE = 4_000_000


def places(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row a value: its place in 0 .. 2^BITS - 1 by the rows before it.

    Values are counted, then ordered by range, so no task holds all of them;
    only one row a task (its number of rows) meets in a window without keys."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ordered = stored(counts.repartitionByRange(F.col(column)).select(
        column, "_n", F.spark_partition_id().alias("_part")), "places")
    tasks = ordered.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tasks = tasks.select("_part", (F.sum("_rows").over(every) - F.col("_rows")).alias("_from"),
                         F.sum("_rows").over(all_rows).alias("_total"))
    inside = (Window.partitionBy("_part").orderBy(column)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("_from") + F.sum("_n").over(inside) - F.col("_n")
    place = F.floor(before.cast("double") / F.col("_total") * F.lit(float(1 << BITS)))
    return (ordered.join(tasks, "_part")
                   .select(column, F.least(place, F.lit((1 << BITS) - 1)).cast("bigint").alias(out)))


def _spread(x: Column) -> Column:
    """The bits of ``x`` (BITS of them) moved apart, a zero before each."""
    step = BITS // 2
    while step:
        kept = sum(((1 << step) - 1) << at for at in range(0, 2 * BITS, 2 * step))
        x = x.bitwiseOR(F.shiftleft(x, step)).bitwiseAND(F.lit(kept).cast("bigint"))
        step //= 2
    return x


def interleaved_bits(a: Column, b: Column) -> Column:
    """Bits of ``a`` and ``b`` in turn, ``a``'s highest first."""
    return F.shiftleft(_spread(a), 1).bitwiseOR(_spread(b))


def interleaved(df: DataFrame, key: str = "symbol", date: str = "trade_date",
                files: int | None = None) -> DataFrame:
    """``df`` in files that prune by ``key`` and by ``date``, ordered inside
    each by the same bits, so that its row groups prune too. NULLs take place 0
    and stay. ``files`` is by default one for each ROWS_PER_FILE rows. ``df``
    is read three times (two counts, one write): give it stored."""
    if files is None:
        files = max(1, -(-df.count() // ROWS_PER_FILE))
    x = df
    for column, place in ((key, "_key_place"), (date, "_date_place")):
        at = places(df, column, place).withColumnRenamed(column, f"{place}_of")
        x = x.join(at, F.col(column) == F.col(f"{place}_of"), "left").drop(f"{place}_of")
    zero = F.lit(0).cast("bigint")
    bits = interleaved_bits(F.coalesce("_key_place", zero), F.coalesce("_date_place", zero))
    order = ["_bits", key, date]
    return (x.withColumn("_bits", bits).drop("_key_place", "_date_place")
             .repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_bits"))
