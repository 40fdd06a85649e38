"""Embedding whitening by a bidiagonal singular value solver.

Integer vectors x are made of the embeddings; the fit list holds each
distinct x once. Its sums are exact. Each task reduces its centred rows to
a triangle by QR, triangles are stacked and reduced again in groups of
``FAN_IN`` until one is left, whose Gram matrix is the covariance: no
covariance is formed, so no digits are lost to squaring. That triangle (as
wide as a vector) is made bidiagonal by Householder reflections; dqds finds
its singular values to high relative accuracy, twisted factorisations their
right vectors, which are turned back by the reflections. A second pass over
the fit list measures what the whitening misses of the identity.

Cases: a row whose vector is null or holds a null or non-finite entry is
left out, also one with an entry whose x is beyond a long, and an empty
vector, which has no component. Vectors of another width are whitened by a
fit list of their own. Repeated rows count once in the fit and stay in the
result. A component whose eigenvalue is nothing beside the largest one has
no direction to scale: ``whitened`` is null there and the identity error is
of the others. Ties (equal eigenvalues) give some orthonormal basis, the
same for all rows. A deviation beyond a long is null. Null ids stay. An
empty table gives no row; columns beside the two named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_batches
from tickwise.session import stored

COMPONENTS = 16
FAN_IN = 16              # triangles that one task stacks
EPS = np.finfo(float).eps
LONG = 2 ** 63 - 1

ROWS = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double")


# ---- the solver: triangle -> singular values and right vectors ----------------

def householder(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and beta such that (I - 2 v v') x = beta e1 (v is 0 if x is)."""
    big = np.max(np.abs(x), initial=0.0)
    if big == 0.0:
        return np.zeros_like(x), 0.0
    v = x / big
    norm = math.sqrt(v @ v)
    sign = 1.0 if v[0] >= 0 else -1.0
    v[0] += sign * norm
    return v / math.sqrt(v @ v), -sign * norm * big


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and right reflections of U' a V for a square a."""
    a = a.copy()
    d = len(a)
    diag, over, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, diag[k] = householder(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k < d - 1:
            v, over[k] = householder(a[k, k + 1:])
            a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ v, v)
            right.append(v)
    return diag, over, right


def _dqds(q: list, e: list, s: float) -> tuple[list, list] | None:
    """One transform of the squared diagonal and superdiagonal with shift
    ``s``; None if the shift is above the smallest value."""
    d = q[0] - s
    if d < 0.0:
        return None
    nq, ne = [], []
    for i, x in enumerate(e):
        pivot = d + x
        if pivot > 0.0:
            t = q[i + 1] / pivot
            ne.append(x * t)
            d = d * t - s
        else:  # both are zero: the matrix falls apart here
            ne.append(0.0)
            d = q[i + 1] - s
        nq.append(pivot)
        if d < 0.0:
            return None
    nq.append(d)
    return nq, ne


def _shifts(q: list, e: list) -> Iterator[float]:
    """Shifts to try, each smaller than the one before is likely to be: the
    lesser value of the last two by two block less its residual, then one over
    the trace of the inverse (a lower bound), then none."""
    a, b, c = q[-2], e[-1], q[-1]
    half = 0.5 * (a + b + c)
    top = half + math.sqrt(max(half * half - a * c, 0.0))
    low = a * c / top if top > 0.0 else 0.0
    if len(q) > 2 and low > 0.0:
        side = math.hypot(c - low, math.sqrt(c * b))
        low -= (abs(c - low) / side if side else 1.0) * math.sqrt(a * e[-2])
    if low > 0.0:
        yield low * (1.0 - 4.0 * EPS)
    total = w = 0.0
    for i, x in enumerate(q):
        if x == 0.0:
            break
        w = (1.0 + (e[i - 1] * w if i else 0.0)) / x
        total += w
    else:
        if math.isfinite(total):
            yield (1.0 - 8.0 * len(q) * EPS) / total
    yield 0.0


def singular_squares(diag: np.ndarray, over: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by dqds
    with deflation at the end, splitting inside, and reversal where the small
    values stand in front."""
    tiny = (8.0 * EPS) ** 2
    out: list[float] = []
    todo = [([float(x) ** 2 for x in diag], [float(x) ** 2 for x in over], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        for _ in range(60 * len(q) + 60):
            if len(q) == 1:
                out.append(sigma + q[0])
                break
            if e[-1] <= tiny * (sigma + q[-1]):
                out.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((i for i, x in enumerate(e) if x <= tiny * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            s, (q, e) = next((s, done) for s in _shifts(q, e) if (done := _dqds(q, e, s)) is not None)
            sigma += s
        else:
            raise ArithmeticError("the singular values do not settle")
    return np.sort(np.array(out))[::-1]


def twisted(diag: np.ndarray, over: np.ndarray, value: float) -> np.ndarray:
    """A unit eigenvector of B'B at ``value``: the stationary transform from
    above and the progressive one from below meet where their joint pivot is
    least, and the vector is read off both ways from there."""
    d = len(diag)
    floor = max(EPS ** 2 * float(np.max(diag ** 2)), np.finfo(float).tiny)
    off = diag[:-1] * over
    down, up = np.empty(d), np.empty(d)       # the s and the p of the transforms
    low, high = np.empty(max(d - 1, 0)), np.empty(max(d - 1, 0))
    down[0] = -value
    for i in range(d - 1):
        pivot = diag[i] ** 2 + down[i]
        pivot = pivot if abs(pivot) > floor else floor
        low[i] = off[i] / pivot
        down[i + 1] = over[i] ** 2 / pivot * down[i] - value
    up[-1] = diag[-1] ** 2 - value
    for i in range(d - 2, -1, -1):
        pivot = over[i] ** 2 + up[i + 1]
        pivot = pivot if abs(pivot) > floor else floor
        high[i] = off[i] / pivot
        up[i] = diag[i] ** 2 / pivot * up[i + 1] - value
    meet = np.abs(down + up + value)
    r = int(np.argmin(np.where(np.isfinite(meet), meet, np.inf)))
    z = np.zeros(d)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(r, d - 1):
        z[i + 1] = -high[i] * z[i]
    return z / np.linalg.norm(z)


def _against(z: np.ndarray, earlier: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """z without its part along ``earlier``, as a unit vector, and what was left of it."""
    left = 1.0
    for _ in range(2):
        for v in earlier:
            z = z - (v @ z) * v
        norm = float(np.linalg.norm(z))
        left *= norm
        if norm == 0.0:
            return z, 0.0
        z = z / norm
    return z, left


def bidiagonal_vectors(diag: np.ndarray, over: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of an upper bidiagonal matrix
    and their right vectors (columns).

    It is solved in the pieces that vanishing superdiagonals leave. Within a
    piece values lie apart, but may agree to working precision: a vector that
    falls into the span of its neighbours' is found by inverse iteration
    against them instead."""
    d = len(diag)
    ends = np.flatnonzero(np.abs(over) <= EPS * np.maximum(np.abs(diag[:-1]), np.abs(diag[1:])) / 4) + 1
    found = []
    for lo, hi in zip([0, *ends], [*ends, d]):
        found += [(x, lo, hi) for x in singular_squares(diag[lo:hi], over[lo:hi - 1])]
    found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
    out: list[np.ndarray] = []
    pieces: dict[int, list[np.ndarray]] = {}
    for value, lo, hi in found:
        earlier = pieces.setdefault(lo, [])
        a, b = diag[lo:hi], over[lo:hi - 1]
        z, left = _against(twisted(a, b, value), earlier)
        if left < 0.5:
            off = a[:-1] * b
            t = np.diag(a ** 2 + np.concatenate([[0.0], b ** 2])) + np.diag(off, 1) + np.diag(off, -1)
            t -= np.eye(hi - lo) * (value + 4 * EPS * found[0][0])
            z, _ = _against(np.cos(np.arange(1.0, hi - lo + 1) * (1 + len(earlier))), earlier)
            for _ in range(4):
                z = np.linalg.solve(t, z)
                z, _ = _against(z / np.linalg.norm(z), earlier)
        earlier.append(z)
        whole = np.zeros(d)
        whole[lo:hi] = z
        out.append(whole)
    return np.array([f[0] for f in found]), np.array(out).T.reshape(d, len(found))


def right_vectors(triangle: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues of R'R, their vectors and its trace."""
    diag, over, right = bidiagonal(triangle)
    values, z = bidiagonal_vectors(diag, over, k)
    for i in range(len(right) - 1, -1, -1):
        z[i + 1:] -= 2.0 * np.outer(right[i], right[i] @ z[i + 1:])
    return values, z, float(np.sum(diag ** 2) + np.sum(over ** 2))


# ---- the passes over the vectors ---------------------------------------------

def vectors(df: DataFrame, vec: str = "embedding", id_col: str = "vec_id", scale: int = 64,
            offset: int = 1_000_000) -> DataFrame:
    """id and x of the rows whose vector is whole: x = floor(scale * entry) + offset."""
    entries = F.transform(F.col(f"`{vec}`"), lambda c: F.floor(c.cast("double") * scale) + offset)
    sound = F.forall(F.col(f"`{vec}`"), lambda c: F.coalesce(F.abs(c.cast("double") * scale) < 9e18, F.lit(False)))
    return df.where(sound & (F.size(F.col(f"`{vec}`")) > 0)).select(F.col(f"`{id_col}`").alias("id"), entries.alias("x"))


def _by_width(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their vectors, a matrix for each width."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for w in np.unique(sizes):
        rows = np.flatnonzero(sizes == w)
        yield rows, flat[starts[rows][:, None] + np.arange(w)]


class Sums:
    """Count and exact sums of the fit list's vectors of one width."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.reach = max(map(abs, sums))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: long where that is safe, else Python integers."""
        if self.n * max(abs(int(x.max())), abs(int(x.min()))) + self.reach < 2 ** 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares, exact; None beyond a long."""
        if centred.dtype != object and float((centred.astype(float) ** 2).sum(axis=1).max()) < 9e18:
            return (centred * centred).sum(axis=1).tolist()
        exact = [sum(int(c) ** 2 for c in row) for row in centred]
        return [v if v <= LONG else None for v in exact]


def fit_sums(fit: DataFrame) -> dict[int, Sums]:
    """Count and sums by width. A task sums high and low halves of the entries
    apart, so none overflows; the driver gets one row a width and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            for rows, x in _by_width(b.column(0)):
                f = found.setdefault(x.shape[1], [0, 0, 0])
                f[0] += len(rows)
                f[1] = f[1] + (x >> 32).sum(axis=0)
                f[2] = f[2] + (x & 0xFFFFFFFF).sum(axis=0)
        for w, (n, high, low) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([w] * w, pa.int32()), pa.array(range(w), pa.int32()), pa.array([n] * w, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["width", "pos", "n", "high", "low"])

    parts = fit.mapInArrow(run, "width int, pos int, n bigint, high bigint, low bigint")
    rows = parts.groupBy("width", "pos").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect()
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.width, r.pos)):
        out.setdefault(r.width, []).append((r.n, (r.high << 32) + r.low))
    return {w: Sums(v[0][0], [s for _, s in v]) for w, v in out.items()}


def _triangle(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _packed(r: np.ndarray) -> bytes:
    return np.ascontiguousarray(r, dtype="<f8").tobytes()


def _unpacked(r: bytes, width: int) -> np.ndarray:
    return np.frombuffer(r, dtype="<f8").reshape(-1, width)


def triangles(fit: DataFrame, sums: dict[int, Sums], fan_in: int = FAN_IN) -> dict[int, np.ndarray]:
    """For each width a triangle R with R'R the covariance of the fit list:
    one a task, then ``fan_in`` of them stacked and reduced again, round by
    round; no task holds more than that many, nor does the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for _, x in _by_width(b.column(0)):
                s, w = sums[x.shape[1]], x.shape[1]
                held = kept.setdefault(w, [])
                held.append((s.centred(x) / s.n).astype(float) / math.sqrt(s.n))
                if sum(map(len, held)) > 4 * w:
                    kept[w] = [_triangle(held)]
        block = TaskContext.get().partitionId()
        for w, held in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([w], pa.int32()), pa.array([block], pa.int32()),
                                              pa.array([_packed(_triangle(held))], pa.binary())],
                                             ["width", "block", "r"])

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        w = t["width"][0].as_py()
        r = _triangle([_unpacked(x, w) for x in t["r"].to_pylist()])
        return pa.table({"width": pa.array([w], pa.int32()),
                         "block": pa.array([t["block"][0].as_py() // fan_in], pa.int32()),
                         "r": pa.array([_packed(r)], pa.binary())})

    parts = stored(fit.mapInArrow(run, "width int, block int, r binary"), "triangles")
    last = parts.agg(F.max("block")).first()[0] or 0
    while last >= fan_in:
        parts = parts.groupBy("width", (F.col("block") / fan_in).cast("int").alias("g")).applyInArrow(
            merge, "width int, block int, r binary")
        last //= fan_in
    out: dict[int, list] = {}
    for r in sorted(parts.collect(), key=lambda r: (r.width, r.block)):
        out.setdefault(r.width, []).append(_unpacked(r.r, r.width))
    whole = {}
    for w, found in out.items():
        r = _triangle(found)
        whole[w] = np.vstack([r, np.zeros((w - len(r), w))])
    return whole


class Whitening:
    """Sums, scaled directions (NaN where there is none) and explained shares
    of one width."""

    def __init__(self, sums: Sums, triangle: np.ndarray, components: int = COMPONENTS):
        values, z, trace = right_vectors(triangle, min(components, len(triangle)))
        self.sums = sums
        none = np.sqrt(values) <= 4 * len(triangle) * EPS * math.sqrt(trace) if trace > 0 else values >= 0
        with np.errstate(divide="ignore", invalid="ignore"):
            self.directions = np.where(none, np.nan, z / np.sqrt(values))
        self.explained = (values / trace if trace > 0 else np.zeros_like(values)).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.sums.n).astype(float) @ self.directions


def train(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each width's fit list (a DataFrame of distinct ``x``)."""
    sums = fit_sums(fit)
    return {w: Whitening(sums[w], r, components) for w, r in triangles(fit, sums).items()}


def identity_error(fit: DataFrame, models: dict[int, Whitening]) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, over the components that have a direction, of all widths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for rows, x in _by_width(b.column(0)):
                m = models[x.shape[1]]
                y = np.hstack([m.whitened(m.sums.centred(x)), np.ones((len(rows), 1))])
                found[x.shape[1]] = found.get(x.shape[1], 0.0) + y.T @ y
        for w, g in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([w] * g.size, pa.int32()), pa.array(range(g.size), pa.int32()),
                                              pa.array(g.ravel())], ["width", "pos", "g"])

    sums = fit.mapInArrow(run, "width int, pos int, g double").groupBy("width", "pos").agg(F.sum("g").alias("g"))
    grams: dict[int, dict[int, float]] = {}
    for r in sums.collect():
        grams.setdefault(r.width, {})[r.pos] = r.g
    worst = 0.0
    for w, g in grams.items():
        side = math.isqrt(len(g))
        g = np.array([g[i] for i in range(len(g))]).reshape(side, side)
        mean = g[-1, :-1] / models[w].sums.n
        error = np.abs(g[:-1, :-1] / models[w].sums.n - np.outer(mean, mean) - np.eye(side - 1))
        worst = max(worst, float(np.nanmax(error)) if not np.isnan(error).all() else 0.0)
    return worst


def transform(rows: DataFrame, models: dict[int, Whitening], error: float = 0.0) -> DataFrame:
    """A row for each row of ``rows`` (id, x) and component, see ``ROWS``."""
    arrow_batches(rows.sparkSession)
    schema = ROWS.replace("vec_id bigint", f"id {rows.schema['id'].dataType.simpleString()}")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _by_width(b.column(1)):
                m = models[x.shape[1]]
                centred = m.sums.centred(x)
                y = m.whitened(centred)
                n, k = y.shape
                each = np.repeat(np.arange(n), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                     pa.array(np.full(n * k, m.sums.n), pa.int64()),
                     pa.array(m.sums.deviations(centred), pa.int64()).take(pa.array(each)),
                     pa.array(y.ravel(), pa.float64(), from_pandas=True),
                     pa.array(np.tile(m.explained, n), pa.float64()), pa.array(np.full(n * k, error))], names)

    return rows.mapInArrow(run, schema)


def whiten(df: DataFrame, vec: str = "embedding", id_col: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """ROWS of every sound row of ``df``, by a whitening of its own distinct vectors."""
    arrow_batches(df.sparkSession)
    rows = vectors(df, vec, id_col)
    fit = stored(rows.select("x").distinct(), "whitening_fit")
    models = train(fit, components)
    return transform(rows, models, identity_error(fit, models)).withColumnRenamed("id", id_col)
