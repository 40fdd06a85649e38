"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are dealt into blocks. A block's index holds, for each dimension,
its postings by quantised impact: a segment lists the vectors whose
component has one sign and falls into one step of ``STEP``. A query runs
through the segments of all dimensions from the highest impact down,
adding the contribution of a whole segment at a time. What is not added
yet is bounded for every vector by its length; the run stops only when
that bound proves which few vectors can still be among the k best. These
are rescored exactly.

Queries are dealt into blocks as well; each query block visits each vector
block. Every task holds one block of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.session import stored

SCALE = 256
BLOCK_ROWS = 16_384       # vectors a block
QUERY_ROWS = 1_024        # queries a block
STEP = 8                  # width of an impact step
CHECKS = 3                # the lowest steps, after each of which a query tests for proof
RESCORED = 8              # a proof that leaves one in so many vectors is good enough to stop
SKIPPED = 0.05            # share of a query's length whose dimensions are left to the bound


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v: floor(SCALE * x) of each component, as double first.
    Vectors that are null or empty or hold a null or non-finite component
    are left out, as are rows of null id."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double"))
                   | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(~bad)
            .select(F.col(id_col).cast("bigint").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE)))).alias("v")))


class Index:
    """Postings of one block by impact: a segment holds the places whose
    component of one dimension has one sign and one step of magnitude.
    Components below a step are in no segment; like everything that
    quantising leaves out, they are covered by the lengths in ``rest``."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows.astype(np.float64)     # exact: below 2**53, and products too
        n, dims = rows.shape
        level = np.abs(rows) // STEP
        value = np.where(level > 0, np.sign(rows) * (level * STEP + (STEP - 1) / 2), 0.0)
        self.norm = np.sqrt((self.rows ** 2).sum(axis=1))
        # rest[j]: length of the rest of each vector once steps down to j are added.
        top = int(level.max(initial=0))
        self.checks = list(range(min(CHECKS, top), 0, -1)) or [1]
        self.rest = {j: np.sqrt(((self.rows - np.where(level >= j, value, 0.0)) ** 2).sum(axis=1))
                     for j in self.checks}
        self.segments: dict[int, list[tuple[int, float, np.ndarray]]] = {}
        for d in range(dims):
            order = np.argsort(value[:, d], kind="stable")
            cuts = np.flatnonzero(np.diff(value[order, d])) + 1
            for part in np.split(order, cuts):
                x = float(value[part[0], d])
                if x:
                    self.segments.setdefault(int(abs(x)) // STEP, []).append((d, x, part))
        self.levels = sorted(self.segments, reverse=True)

    def search(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows but the query's own id."""
        free = self.ids != own
        if np.count_nonzero(free) <= k:
            return self._rescored(np.flatnonzero(free), q, k)
        q = q.astype(np.float64)
        length = np.sqrt(q @ q)
        # Dimensions that hold SKIPPED of the query's length are left to the bound.
        order = np.argsort(np.abs(q), kind="stable")
        small = order[np.sqrt(np.cumsum(q[order] ** 2)) <= SKIPPED * length]
        used = np.ones(len(q), dtype=bool)
        used[small] = False
        skipped = np.sqrt((q[small] ** 2).sum()) * self.norm
        weight = np.where(used, q, 0.0).tolist()
        total = np.zeros(len(self.ids))
        at = None
        todo = list(self.levels)
        for j in self.checks:
            while todo and todo[0] >= j:
                for d, x, part in self.segments[todo.pop(0)]:
                    w = weight[d]
                    if w:
                        total[part] += w * x
            # By Cauchy and Schwarz, a score is this near; a unit more for rounding.
            error = length * self.rest[j] + skipped + 1.0
            sure = np.where(free, total - error, -np.inf)
            bar = np.partition(sure, len(sure) - k)[len(sure) - k]
            at = np.flatnonzero(free & (total + error >= bar))
            if len(at) <= max(4 * k, len(free) // RESCORED):
                break
        return self._rescored(at, q, k)

    def _rescored(self, at: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        exact = self.rows[at] @ q.astype(np.float64)
        best = np.lexsort((self.ids[at], -exact))[:k]
        return self.ids[at][best], exact[best]


def _large(x: np.ndarray) -> np.ndarray:
    """Rows with a component too large for sums of products in doubles to be
    exact (taken as doubles: the least long has no positive counterpart)."""
    return np.abs(x.astype(np.float64)).max(axis=1, initial=0.0) * float(x.shape[1]) ** 0.5 >= 2.0 ** 25


def _exact(ids: np.ndarray, rows: np.ndarray, q: np.ndarray, k: int, own: int):
    """As ``Index.search`` for components too large for it: integers of any size."""
    at = np.flatnonzero(ids != own)
    scores = [min(max(sum(int(a) * int(b) for a, b in zip(rows[i], q)), -1 << 63), (1 << 63) - 1) for i in at]
    best = sorted(range(len(at)), key=lambda j: (-scores[j], ids[at[j]]))[:k]
    return ids[at[best]], np.array([scores[j] for j in best], dtype=object)


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``is_query``
    (a column over vec_id) admits its k highest integer inner products with
    the other rows, all if there are fewer, ties to the smaller vec_id.

    Left out: see ``quantise``. A row is never a candidate of a query of its
    own id; repeated rows of another id are candidates each, of rows with a
    query's id the one with the smallest vector asks. Vectors of
    another length than the query's are no candidates. Scores beyond a long
    stop at its ends. No rows: none.
    """
    spark = vectors.sparkSession
    clean = stored(quantise(vectors, id_col, vector).withColumn("width", F.size("v")), "quantised")
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")

    def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
        """Rows dealt by a hash of the id into blocks of about ``size``."""
        many = max(1, -(-rows.count() // size))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Rows come sorted by block and width: one output row for each.
            now, ids, parts, n = None, [], [], 0

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                     pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                     pa.array([np.concatenate(parts).tobytes()], pa.binary())], ["block", "width", "ids", "data"])

            for b in batches:
                keys = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
                cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
                flat, starts = b.column(3).flatten().to_numpy(), np.cumsum([0, *keys[:, 1]])
                for i, j in zip(cuts, cuts[1:]):
                    if i == j:
                        continue
                    key = tuple(keys[i].tolist())
                    if now is not None and (key != now or n + j - i > 2 * size):
                        yield out()
                        ids, parts, n = [], [], 0
                    now = key
                    ids.append(b.column(2).to_numpy()[i:j])
                    parts.append(flat[starts[i]:starts[j]])
                    n += j - i
            if n:
                yield out()

        dealt = (rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(many)).cast("int").alias("block"), "width",
                             "vec_id", "v").repartitionById(many, F.col("block"))
                 .sortWithinPartitions("block", "width", "vec_id"))
        packed = dealt.mapInArrow(pack, "block int, width int, ids binary, data binary")
        return stored(packed, name), many

    data, n_data = blocks(clean, BLOCK_ROWS, "vector_blocks")
    queries = clean.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("width", F.size("v"))
    asked, _ = blocks(queries, QUERY_ROWS, "query_blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for b in batches:
            for ids, rows, width, q_ids, q_rows in zip(*(b.column(i).to_pylist() for i in range(5))):
                out = []
                if (ids, width) != held:
                    held, index = (ids, width), None
                    x_ids = np.frombuffer(ids, dtype=np.int64)
                    x = np.frombuffer(rows, dtype=np.int64).reshape(-1, width)
                    large = _large(x)
                q_id = np.frombuffer(q_ids, dtype=np.int64)
                qs = np.frombuffer(q_rows, dtype=np.int64).reshape(-1, width)
                if index is None and not large.all():
                    index = Index(x_ids[~large], x[~large])
                for own, q, beyond in zip(q_id.tolist(), qs, _large(qs)):
                    exact = np.ones(len(x), bool) if beyond else large
                    if not exact.all():
                        got, scores = index.search(q, k, own)
                        out += [(own, int(i), int(s)) for i, s in zip(got, scores)]
                    if exact.any():
                        got, scores = _exact(x_ids[exact], x[exact], q, k, own)
                        out += [(own, int(i), int(s)) for i, s in zip(got, scores)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in (zip(*out) if out else ([], [], []))],
                    ["query_id", "vec_id", "score"])

    # Each query block (some 0.5 MB) visits each vector block.
    visits = asked.select("width", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_data - 1))).alias("block"))
    met = (data.join(visits, ["block", "width"]).select("ids", "data", "width", "q_ids", "q_data"))
    found = met.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
