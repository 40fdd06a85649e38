"""Filter interaction audit by count-weighted decision diagrams.

Filters are applied to documents one after the other; what each removes
depends on those before it. One pass over the texts gives every document a
failure mask (one bit a filter). A part's masks are counted in Spark; a
part's diagram then has one level a filter, a pass and a fail edge at each
node, equal sub-diagrams shared, and at each node the documents that reach
it. Swapping two neighbouring levels rewrites only the nodes of those two,
so a walk through all orders by single swaps keeps one diagram a part; in
each order the path of pass edges from the root gives its steps.

Cases: a null text is an empty one; a null part is the empty string; texts
are compared whole, by SHA-256. A document fails ``duplicate`` if a smaller
id has its text; among rows of equal id and text none does, and a null id
stands behind all others. Labels of one id that contradict each other count
if any of them is 1. An empty table has no parts and gives no row. Columns
beside those named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_texts
from tickwise.session import stored

#: The filters by letter, in the order of their mask bits.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))  # the bytes of a code point after its first
WEIGHTS = ("n", "good", "toxic")

ROWS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def text_mask(text: bytes) -> int:
    """Bits of the filters that look at the text alone (A-D)."""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D
    n = len(words)
    points = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3)


def _measure():
    def run(texts):
        texts = [t or b"" for t in texts]
        return [hashlib.sha256(t).digest() for t in texts], [text_mask(t) for t in texts]
    return run


def failure_masks(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """part, mask, n, good, toxic: documents by part and failure mask, and
    those of them whose label ``quality`` or ``toxic`` is 1.

    Only digests, ids and masks are shuffled. Rows that agree in all of them
    are counted first, so a text that a third of all rows share meets one
    task only as that many partial minima; the rows that pass the duplicate
    filter are found by a join on digest and id, which no copy shares."""
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                         F.col(text).alias("text"))
    seen = map_texts(picked, "text", ["id", "part"], [("digest", "binary"), ("mask", "int")], _measure, binary=True)
    units = stored(seen.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "mask_units")
    first = units.groupBy("digest").agg(F.min("id").alias("first")).select(
        F.col("digest").alias("d"), "first", F.lit(True).alias("is_first"))
    marked = units.join(first, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("first")), "left")
    mask = F.col("mask") + F.when(F.col("is_first"), 0).otherwise(1 << FILTERS.index("E"))
    by_id = marked.groupBy("id", "part", mask.alias("mask")).agg(F.sum("n").alias("n"))
    flags = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    both = by_id.join(flags, F.col("id") == F.col("l_id"), "left")
    count = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good").alias("good"),
                                            count("toxic").alias("toxic"))


@dataclass(eq=False, slots=True)
class Node:
    """A node that documents reach: passing its level's filter leads to
    ``ok``, failing to ``fail`` (nodes of the next level, at the last one
    the weights themselves)."""
    ok: object
    fail: object
    weight: tuple[int, ...]


def _weight(x) -> tuple[int, ...]:
    return x if isinstance(x, tuple) else x.weight


class Diagram:
    """A count-weighted decision diagram over failure masks.

    ``counts`` maps a mask to its weights; ``order`` starts as the mask's
    bits. All nodes of a level decide the same filter and no level is
    skipped, so a node's weight is the sum over its edges in any order."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: str):
        self.order = list(filters)
        zero = (0,) * len(next(iter(counts.values())))
        self.levels: list[list[Node]] = [[] for _ in filters]
        shared: list[dict] = [{} for _ in filters]

        def build(level: int, mask: int):
            if level == len(filters):
                return counts.get(mask, zero)
            return self._node(shared[level], build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)
        self.levels = [list(s.values()) for s in shared]

    @staticmethod
    def _node(shared: dict, ok, fail) -> Node:
        """The level's node with these edges; equal sub-diagrams are one object,
        so edges are compared by identity (weights by value)."""
        key = tuple(x if isinstance(x, tuple) else id(x) for x in (ok, fail))
        if key not in shared:
            shared[key] = Node(ok, fail, tuple(a + b for a, b in zip(_weight(ok), _weight(fail))))
        return shared[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of this level and the next: each node of the
        level keeps its documents and its place, its edges are dealt anew."""
        below: dict = {}
        for node in self.levels[level]:
            ok, fail = node.ok, node.fail
            node.ok = self._node(below, ok.ok, fail.ok)
            node.fail = self._node(below, ok.fail, fail.fail)
        self.levels[level + 1] = list(below.values())
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> list[Node]:
        """The nodes on the path of pass edges, from the root on."""
        path = [self.root]
        for _ in self.order[1:]:
            path.append(path[-1].ok)
        return path


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, to pass through every order of
    ``n`` filters once: the last filter sweeps to and fro through each order
    of the others."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        # the sweeping filter stands first after a sweep down, last after one up
        yield step + 1 if down else step
        down = not down


def steps(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> Iterator[tuple]:
    """filter_order, step, then ROWS from ``kept`` on, for every order; the
    weights are documents, good and toxic ones."""
    diagram = Diagram(counts, filters)
    paths: dict[str, list[tuple]] = {}

    def note():
        paths["".join(diagram.order)] = [(f, _weight(node.ok)[0], *_weight(node.fail))
                                         for f, node in zip(diagram.order, diagram.all_pass())]

    note()
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        note()
    fails = {path[0][0]: path[0][2] for path in paths.values()}         # at the root: all that fail it
    alone = {path[-1][0]: path[-1][2] for path in paths.values()}       # at the end: those that fail no other
    shapley = dict.fromkeys(filters, 0)
    for path in paths.values():
        for f, _, removed, *_ in path:
            shapley[f] += removed
    for order, path in paths.items():
        for i, (f, kept, removed, good, toxic) in enumerate(path):
            yield order, i + 1, kept, removed, fails[f] - removed, alone[f], good, toxic, shapley[f]


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """ROWS for each part, order and step, from ``failure_masks``. A part's
    masks are at most two to the number of filters, whatever its documents."""
    grouped = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("masks"))
    names = [c.split()[0] for c in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = list(steps({m["mask"]: tuple(m[w] for w in WEIGHTS) for m in found}, filters))
                columns = [[part] * len(rows), *map(list, zip(*rows))]
                types = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return grouped.mapInArrow(run, ROWS)

