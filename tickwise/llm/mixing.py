"""Mixing sources to target weights by min-cost flow.

Documents are added up by membership pattern (the set of sources that a
document belongs to). A flow network carries their tokens: from each
pattern, once for free and once more for each repetition at a rising
(convex) cost, to the sources of the pattern, and from each source to its
target. The cheapest largest flow says how many tokens each pattern gives;
its documents are then taken in a seeded order: all of them for whole
passes, those first in order for the rest of a pass.

Only sums by pattern reach the driver, ``MAX_PATTERNS`` at most. The order
is a 63-bit hash, and the place where a pass ends is found by narrowing
sums over nine bits at a time, so no pattern's documents are ever sorted or
gathered, however many rows it has.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import fresh, local_rows
from tickwise.session import stored

MAX_PATTERNS = 100_000
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)         # repeating, over the sources in order
SHARE = 1.5                 # of all sizes that the mix holds
REPEATS = 2                 # most times that a document is taken
SEED = 7
_KEY_BITS, _DIGIT = 63, 9   # the order's bits, and those narrowed at a time


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def order_key(id_col: str, text: str, seed: int = SEED) -> Column:
    """63 seeded bits of a document; equal ids with equal texts are alike."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)), 1)


def pattern_of(source: str) -> Column:
    """The membership pattern of a document of one source (null counts as one)."""
    return F.to_json(F.array(F.col(source).cast("string")), {"ignoreNullFields": "false"})


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            repeats: int = REPEATS) -> list[float]:
    """Share ``share`` of all sizes by weight; a target stops at ``repeats``
    times its source's size, the excess is shared anew among the others by
    weight until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    left, rest = share * sum(sizes), set(range(len(sizes)))
    while rest:
        total = sum(w[i] for i in rest)
        over = {i for i in rest if left * w[i] / total > repeats * sizes[i]}
        for i in rest if not over else over:
            out[i] = left * w[i] / total if not over else float(repeats * sizes[i])
        if not over:
            break
        rest -= over
        left -= sum(repeats * sizes[i] for i in over)
    return out


def min_cost_flow(capacity: list[int], members: list[list[int]], quotas: list[int],
                  repeats: int = REPEATS) -> list[list[int]]:
    """Tokens from each pattern to each of its sources (in their order).

    Successive shortest paths: a path leaves a pattern at its next
    repetition's cost, may turn tokens of other patterns to another source,
    and ends at a source below its quota.
    """
    flow = [[0] * len(m) for m in members]
    into: list[list[tuple[int, int]]] = [[] for _ in quotas]     # source -> (pattern, place)
    for p, m in enumerate(members):
        for k, s in enumerate(m):
            into[s].append((p, k))
    need = list(quotas)
    for repeat in range(repeats):        # repetition r costs r a token: cheaper ones first
        room = list(capacity)
        for p in range(len(members)):
            while room[p] > 0:
                # Breadth first over sources: which pattern's tokens to turn on the way.
                came: dict[int, tuple[int, int, int] | None] = {}
                queue: deque[int] = deque()
                for k, s in enumerate(members[p]):
                    if s not in came:
                        came[s] = (-1, p, k)
                        queue.append(s)
                end = None
                while queue:
                    s = queue.popleft()
                    if need[s] > 0:
                        end = s
                        break
                    for q, k in into[s]:
                        if flow[q][k] > 0:
                            for k2, s2 in enumerate(members[q]):
                                if s2 not in came:
                                    came[s2] = (s, q, k2)
                                    queue.append(s2)
                if end is None:
                    break
                path, s = [], end
                while s >= 0:
                    before, q, k = came[s]
                    path.append((before, q, k))
                    s = before
                push = min(room[p], need[end])
                for before, q, _ in path[:-1]:
                    push = min(push, flow[q][members[q].index(before)])
                for before, q, k in path:
                    flow[q][k] += push
                    if before >= 0:
                        flow[q][members[q].index(before)] -= push
                need[end] -= push
                room[p] -= push
    return flow


@dataclass(frozen=True)
class Plan:
    """By pattern: whole passes, and the last key taken once more (-1: none);
    by source: size and target."""
    passes: dict[str, int]
    last_key: dict[str, int]
    source_size: dict[str | None, int]
    target: dict[str | None, float]

    def frame(self, spark) -> DataFrame:
        rows = [(p, n, self.last_key[p]) for p, n in self.passes.items()]
        return local_rows(spark, rows, "pattern string, passes int, last_key bigint")


def copies() -> Column:
    """How often a row that has its pattern's passes and last_key is taken."""
    return F.col("passes") + (F.col("key") <= F.col("last_key")).cast("int")


def _last_keys(rows: DataFrame, rest: dict[str, int]) -> dict[str, int]:
    """For each pattern the key up to which its documents' sizes come nearest
    to ``rest`` tokens, found digit by digit. ``rows``: pattern, key, size."""
    spark = rows.sparkSession
    prefix = {p: 0 for p in rest}
    left = dict(rest)
    for shift in range(_KEY_BITS - _DIGIT, -1, -_DIGIT):
        if not prefix:
            break
        at = F.broadcast(local_rows(spark, list(prefix.items()), "pattern string, prefix bigint"))
        inside = rows.join(at, "pattern").where(
            F.shiftrightunsigned("key", shift + _DIGIT) == F.col("prefix"))
        sums = (inside.groupBy("pattern", F.shiftrightunsigned("key", shift).alias("part"))
                .agg(F.sum("size").alias("size")))
        # Digits are at most 512 a pattern: a small window, one row a pattern out.
        run = Window.partitionBy("pattern").orderBy("part")
        sums = sums.withColumn("upto", F.sum("size").over(run))
        need = F.broadcast(local_rows(spark, list(left.items()), "pattern string, need bigint"))
        found = (sums.join(need, "pattern").where("upto > need")
                 .groupBy("pattern").agg(F.min(F.struct("part", "upto", "size")).alias("x"))
                 .select("pattern", "x.*").collect())
        prefix = {r["pattern"]: r["part"] for r in found}
        for r in found:
            left[r["pattern"]] -= r["upto"] - r["size"]
            if shift == 0:      # one key is left: in if more than half of it fits
                prefix[r["pattern"]] = r["part"] if 2 * left[r["pattern"]] > r["size"] else r["part"] - 1
    return {p: prefix.get(p, (1 << _KEY_BITS) - 1) for p in rest}


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
         repeats: int = REPEATS) -> Plan:
    """Plan the mix of ``rows``: pattern (JSON list of sources), size, key.
    They are read a few times: give a stored table. No rows: an empty plan."""
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} membership patterns")
    sums = sorted((r["pattern"], r["size"] or 0) for r in sums)
    member_names = [json.loads(p) for p, _ in sums]
    names = sorted({s for m in member_names for s in m if s is not None})
    names += [None] if any(None in m for m in member_names) else []
    index = {s: i for i, s in enumerate(names)}
    members = [sorted({index[s] for s in m}) for m in member_names]
    sizes = [0] * len(names)
    for (_, size), m in zip(sums, members):
        for s in m:
            sizes[s] += size
    aims = targets(sizes, weights, share, repeats)
    flow = min_cost_flow([size for _, size in sums], members, [round(t) for t in aims], repeats)
    passes, rest = {}, {}
    for (p, size), f in zip(sums, flow):
        total = sum(f)
        passes[p] = total // size if size else 0
        if size and total % size:
            rest[p] = total % size
    last = _last_keys(rows.select("pattern", "key", "size"), rest)
    return Plan(passes, {p: last.get(p, -1) for p, _ in sums}, dict(zip(names, sizes)), dict(zip(names, aims)))


def mix_sizes(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Null texts have size 0 and are never taken; a null source is a source,
    last in order. Rows with equal id and text are taken alike, so reruns
    agree. No rows: none.
    """
    spark = docs.sparkSession
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
                              word_count(F.col(text)).alias("size"), order_key(id_col, text).alias("key"))
                  .withColumn("pattern", pattern_of("source")), "mix_rows")
    p = plan(rows)
    names = {x: json.loads(x)[0] for x in p.passes}
    table = [(x, n, p.last_key[x], p.source_size[names[x]], p.target[names[x]]) for x, n in p.passes.items()]
    # A row a pattern: at most MAX_PATTERNS, as plan() has checked.
    of_pattern = F.broadcast(local_rows(
        spark, table, "pattern string, passes int, last_key bigint, source_size bigint, target double"))
    return rows.join(of_pattern, "pattern").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, each as often as the
    mix takes it (0, 1 or 2 times); texts without words go."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
                         order_key(id_col, text).alias("key")).withColumn("pattern", pattern_of("source"))
    p = plan(stored(narrow.drop("source"), "mix_rows"))
    row, key, pat, n = (fresh(docs.columns, x) for x in ("_row", "_key", "_pattern", "_n"))
    table = F.broadcast(p.frame(spark))
    taken = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         order_key(id_col, text).alias("key"), pattern_of(source).alias("pattern"),
                         word_count(F.col(text)).alias("size"))
             .join(table, "pattern").where("size > 0")
             .withColumn(n, copies()).where(F.col(n) > 0)
             .select(row, F.explode(F.array_repeat(F.lit(1), F.col(n))).alias(key)))
    return taken.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
