"""Quality classifier: Naive Bayes support vectors.

A text is the set (indicators, not counts) of its hashed character
trigrams, case and signs kept, and of its word-pair marks: whether words,
pairs of words or lines come again. ``train`` counts, over every labelled
training text, in how many texts of each class an indicator occurs; the
logarithm of the ratio of the two smoothed shares scales it. A linear
hinge-loss model over the scaled indicators is then fitted by dual
coordinate descent, and a logistic curve turns its margin into a score.

The counts cover all labelled training rows. The descent takes at most
``SAMPLE_ROWS`` of them (those first by a hash of their id) and
``SAMPLE_SLOTS`` indicators in all, in one task; its result is two arrays
of ``1 << BITS`` numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_batches, fresh, join_checked, map_texts

BITS = 17
MARK_SLOTS = 64             # the first slots are for the marks
SAMPLE_ROWS = 6_000         # most labelled rows for the descent
SAMPLE_SLOTS = 6_000_000    # most indicators that these rows hold together
COST = 1.0                  # of the hinge loss
EPOCHS = 30
SMOOTH = 1.0                # added to each class's indicator counts
PIECE = 1 << 20             # code points that are hashed at a time


def _steps(share: float) -> int:
    """0 for none, then 1 to 9 by how large the share is."""
    return 0 if share <= 0 else 1 + min(8, int(share * 9))


def marks(text: str) -> list[int]:
    """Slots below ``MARK_SLOTS`` that tell of repetition."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return [0]
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(words, words[1:]))
    twins = sum(a == b for a, b in pairs)
    return [1 + _steps(twins / n),
            11 + _steps(1 - len(set(pairs)) / len(pairs) if pairs else 0),
            21 + _steps(1 - len(set(lines)) / len(lines) if lines else 0),
            31 + min(9, n.bit_length())]


def indicators(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The distinct slots of a whole text. ``seen`` is a scratch array of
    ``1 << BITS`` falses and is left so."""
    t = text or ""
    codes = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    for at in range(0, max(len(codes) - 2, 0), PIECE):
        c = codes[at:at + PIECE + 2]
        key = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77)
               ^ c[2:] * np.uint32(0xC2B2AE3D))
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x27D4EB2F)
        seen[(key >> np.uint32(32 - BITS)) | np.uint32(MARK_SLOTS)] = True
    seen[marks(t)] = True
    slots = np.flatnonzero(seen)
    seen[slots] = False
    return slots


@dataclass(frozen=True)
class Model:
    weight: np.ndarray      # by slot, the log-count ratio already in it
    bias: float
    slope: float            # of the logistic curve over the margin
    offset: float

    def score(self, slots: np.ndarray) -> float:
        margin = self.weight[slots].sum() / np.sqrt(len(slots)) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one dual variable a row,
    in [0, COST], set to its optimum with the others fixed. Ends when no
    projected gradient exceeds 0.01, or after ``EPOCHS``."""
    w, b = np.zeros(len(ratio)), 0.0
    scaled = [ratio[s] / np.sqrt(len(s)) for s in rows]
    square = np.array([v @ v + 1.0 for v in scaled])
    # Classes weigh alike, whatever their share of the rows.
    share = np.array([(y < 0).mean(), (y > 0).mean()])
    cap = np.where(y > 0, 0.5 / max(share[1], 1e-9), 0.5 / max(share[0], 1e-9)) * COST
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (scaled[i] @ w[rows[i]] + b) - 1.0
            pg = min(g, 0.0) if alpha[i] == 0 else max(g, 0.0) if alpha[i] == cap[i] else g
            worst = max(worst, abs(pg))
            if pg:
                old = alpha[i]
                alpha[i] = min(max(old - g / square[i], 0.0), cap[i])
                step = (alpha[i] - old) * y[i]
                w[rows[i]] += step * scaled[i]
                b += step
        if worst <= 0.01:
            break
    return w, b


def calibrate(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method with a
    weak pull, the classes at their shares."""
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * margin + c, -500, 500)))
        r, h = p - good, p * (1 - p) + 1e-9
        grad = np.array([r @ margin + 1e-3 * a, r.sum() + 1e-3 * c])
        hess = np.array([[h @ margin ** 2 + 1e-3, h @ margin], [h @ margin, h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (a, c) if a > 0 else (1.0, c)


def fit(rows: list[np.ndarray], good: np.ndarray, counts: np.ndarray) -> Model:
    """From the sample's rows and labels and the class counts of all rows."""
    size = 1 << BITS
    if not len(rows) or good.all() or not good.any():
        # One class only, or none: the same score for all, its smoothed share.
        p = (good.sum() + 1.0) / (len(good) + 2.0)
        return Model(np.zeros(size), 0.0, 1.0, float(np.log(p / (1 - p))))
    share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    # Margins of rows that a descent has not seen calibrate the score.
    part = np.arange(len(rows)) % 5 == 0
    y = np.where(good, 1.0, -1.0)
    if good[part].all() or not good[part].any() or good[~part].all() or not good[~part].any():
        part[:] = True
        seen_by = part
    else:
        seen_by = ~part
    w, b = descend([r for r, s in zip(rows, seen_by) if s], y[seen_by], ratio)
    first = Model(w * ratio, b, 1.0, 0.0)
    margin = np.array([first.weight[r].sum() / np.sqrt(len(r)) + b for r, s in zip(rows, part) if s])
    slope, offset = calibrate(margin, good[part].astype(float))
    return Model(first.weight, b, slope, offset)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows of ``docs`` (doc_id and text) that ``labels``
    (unique doc_id; y: 0 or 1) names. No such row leaves a model that scores
    every text 0.5."""
    spark = docs.sparkSession
    arrow_batches(spark)
    known = join_checked(docs.select("doc_id", F.col(text).cast("string").alias("text")), labels, "doc_id")
    known = known.select("doc_id", "text", "y")
    size = 1 << BITS

    def count(batches):
        sums = np.zeros((2, size), dtype=np.int64)
        seen = np.zeros(size, dtype=bool)
        n = np.zeros(2, dtype=np.int64)
        for b in batches:
            for t, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                sums[y][indicators(t, seen)] += 1
                n[y] += 1
        for y in (0, 1):
            at = np.flatnonzero(sums[y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), y, dtype=np.int32)), pa.array(at.astype(np.int32)),
                 pa.array(sums[y][at])], ["y", "slot", "n"])

    rows = (known.mapInArrow(count, "y int, slot int, n bigint")
            .groupBy("y", "slot").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((2, size))
    if len(rows):
        counts[rows["y"].to_numpy(), rows["slot"].to_numpy()] = rows["n"].to_numpy()

    # The first ids by hash; their texts are then read by those ids alone.
    ids = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    order = fresh(["doc_id", "text", "y"], "h")
    sample = (join_checked(docs.select("doc_id", F.col(text).cast("string").alias("text")), ids, "doc_id")
              .select("doc_id", "text", "y", F.xxhash64("doc_id").alias(order)))

    def sets(batches):
        seen = np.zeros(size, dtype=bool)
        for b in batches:
            got = [indicators(t, seen).astype(np.int32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(3), b.column(0).cast(pa.string()), b.column(2),
                                              pa.array(got, pa.binary())], ["h", "id", "y", "slots"])

    def descent(batches):
        rows, y, held = [], [], 0
        for b in batches:
            for label, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                slots = np.frombuffer(s, dtype=np.int32)
                held += len(slots)
                if len(rows) and (held > SAMPLE_SLOTS or len(rows) >= sample_rows):
                    continue
                rows.append(slots)
                y.append(label)
        m = fit(rows, np.array(y, dtype=int) == 1, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.weight.tobytes()], pa.binary()), pa.array([m.bias]), pa.array([m.slope]),
             pa.array([m.offset])], ["weight", "bias", "slope", "offset"])

    one = (sample.mapInArrow(sets, "h bigint, id string, y int, slots binary")
           .repartition(1).sortWithinPartitions("h", "id", "slots"))
    got = one.mapInArrow(descent, "weight binary, bias double, slope double, offset double").collect()
    if not got:
        return fit([], np.zeros(0, dtype=bool), counts)
    return Model(np.frombuffer(got[0]["weight"], dtype=np.float64), got[0]["bias"], got[0]["slope"],
                 got[0]["offset"])


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, then score (0 to 1, higher: label 1 likelier) of
    every whole text. Null and empty texts get the score of a text without
    words; repeated rows are scored each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m, seen = shared.value, np.zeros(1 << BITS, dtype=bool)
        return lambda texts: [[m.score(indicators(t, seen)) for t in texts]]

    return map_texts(docs, text, ["doc_id"] if keep is None else keep, [("score", "double")], make)
