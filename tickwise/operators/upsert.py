"""Keyed upsert of a batch into a table.

Semantics of ``INSERT ... ON CONFLICT (key) DO UPDATE SET`` for a chosen set
of columns: a key present in the batch takes the batch's value of every
updated column, NULL included; every other column keeps the table's value
when the key existed; a new key takes all of its values from the batch.

Plan: one full outer join on the key (presence flags rather than
``coalesce``, so NULLs are respected). A scheduled job restricts the
target to the partitions the batch touches before the join and rewrites
only those (``jobs.publish``), so the join's size follows the batch, not
the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_batch(batch: DataFrame, keys: list[str], update_cols: list[str],
                 seq_col: str = "batch_seq") -> DataFrame:
    """Rows run one after another, so for a key repeated in the batch the
    last row's updated columns win and the first row's other columns stay.
    Order comes from an explicit sequence column, never from arrival order."""
    others = [c for c in batch.columns if c not in keys and c not in update_cols and c != seq_col]
    aggs = [F.max_by(F.struct(*[F.col(c) for c in update_cols]), seq_col).alias("_last")]
    if others:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in others]), seq_col).alias("_first"))
    g = batch.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_last.{c}").alias(c) for c in update_cols]
    cols += [F.col(f"_first.{c}").alias(c) for c in others]
    return g.select(*cols).select(*[c for c in batch.columns if c != seq_col])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           update_cols: list[str]) -> DataFrame:
    """The table after applying ``batch`` (keys unique in both)."""
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"t__{c}") for c in cols], F.lit(True).alias("_in_t"))
    b = batch.select(*keys, *[F.col(c).alias(f"b__{c}") for c in cols if c in batch.columns],
                     F.lit(True).alias("_in_b"))
    j = t.join(b, keys, "full_outer")
    in_t, in_b = F.coalesce(F.col("_in_t"), F.lit(False)), F.coalesce(F.col("_in_b"), F.lit(False))
    out = [F.col(k) for k in keys]
    for c in cols:
        bc = F.col(f"b__{c}") if c in batch.columns else F.lit(None)
        if c in update_cols:
            out.append(F.when(in_b, bc).otherwise(F.col(f"t__{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t__{c}")).otherwise(bc).alias(c))
    return j.select(*out)


def upsert_with_duplicates(target: DataFrame, batch: DataFrame, keys: list[str],
                           update_cols: list[str], seq_col: str = "batch_seq") -> DataFrame:
    """A19 + A16: dedupe the batch by sequence, then upsert."""
    return upsert(target, dedupe_batch(batch, keys, update_cols, seq_col), keys, update_cols)


def sequenced(batch: DataFrame, seq_col: str = "batch_seq") -> DataFrame:
    """``batch`` with ``first_seq`` and ``last_seq`` in place of its sequence."""
    return (batch.withColumn("first_seq", F.col(seq_col)).withColumn("last_seq", F.col(seq_col))
                 .drop(seq_col))


def settle_sequenced(rows: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """A19 on rows from ``sequenced``: of all rows of a key, the one of the
    highest ``last_seq`` gives the updated columns, that of the lowest
    ``first_seq`` the others; rows of equal sequence are told apart by their
    values. A row without a sequence (a batch load's) comes before all that
    have one. ``loaded_at`` is when the winning values first came, so settling
    them again changes nothing. One partially aggregated shuffle on the key."""
    others = [c for c in rows.columns if c not in keys and c not in update_cols
              and c not in ("first_seq", "last_seq", "loaded_at")]
    since = [(-F.unix_micros("loaded_at")).alias("_since")] if "loaded_at" in rows.columns else []
    g = rows.groupBy(*keys).agg(F.max(F.struct("last_seq", *update_cols, *since)).alias("_last"),
                                F.min(F.struct("first_seq", *others)).alias("_first"))
    out = g.select(*keys, "_last.*", "_first.*")
    if since:
        out = out.withColumn("loaded_at", F.timestamp_micros(-F.col("_since")))
    return out.select(*rows.columns)


def merge_sequenced(target: DataFrame, batch: DataFrame, keys: list[str],
                    update_cols: list[str]) -> DataFrame:
    """A19 across batches: stored and new rows settled together. This is
    associative and idempotent, so neither the order of the batches nor
    their cut changes the table."""
    return settle_sequenced(target.select(*batch.columns).unionByName(batch), keys, update_cols)


def watermarks(rows: DataFrame, symbol_col: str = "symbol", date_col: str = "trade_date") -> DataFrame:
    """The last loaded date of each symbol: one row per symbol."""
    return rows.groupBy(symbol_col).agg(F.max(date_col).alias("last_date"))


def since_watermark(marks: DataFrame, batch: DataFrame, start_date: str,
                    symbol_col: str = "symbol", date_col: str = "trade_date") -> DataFrame:
    """Keep batch rows on or after the symbol's last loaded date (the last
    day is fetched again), or on or after ``start_date`` for a new symbol.
    ``marks`` comes from ``watermarks``."""
    j = batch.join(marks.select(symbol_col, F.col("last_date").alias("_last")), symbol_col, "left")
    start = F.coalesce(F.col("_last"), F.lit(start_date).cast("date"))
    return j.where(F.col(date_col) >= start).drop("_last")


def incremental_filter(target: DataFrame, batch: DataFrame, start_date: str,
                       symbol_col: str = "symbol", date_col: str = "trade_date") -> DataFrame:
    """A20 against the loaded rows themselves. Loads that keep their
    watermarks in a table (``jobs.run_load``) don't read those again."""
    return since_watermark(watermarks(target, symbol_col, date_col), batch, start_date, symbol_col, date_col)


# Columns the reference updates on conflict, per table.
BAR_KEYS, BAR_UPDATES = ["symbol", "trade_date"], ["open", "high", "low", "close", "adj_close", "volume"]
MACRO_KEYS, MACRO_UPDATES = ["obs_date", "series"], ["value"]
ASSET_KEYS, ASSET_UPDATES = ["symbol"], ["name", "sector", "subsector", "kind", "active"]
