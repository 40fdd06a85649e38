"""Kneser-Ney scores against a plain dictionary implementation."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.llm import kneser_ney as K
from tickwise.llm.queries import QUERIES

B, E = b" <s>", b" </s>"


def words(t):
    return [*(t or "").encode().lower().split(), E]


def plain(rows):
    """rows: (id, learned, text) -> {id: (n_tokens, n_known, N, base, score)}"""
    c1, c2 = Counter(), Counter()
    for _, y, t in rows:
        if y:
            w = words(t)
            c1.update(w)
            c2.update(zip([B, *w], w))
    n_all, n_words = sum(c1.values()), len(c1)
    follow = Counter(w for _, w in c2)
    ctx = defaultdict(Counter)
    for (v, w), n in c2.items():
        ctx[v][w] = n

    def counts(c):
        return [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
    high, low = K.discounts(*counts(c2)), K.discounts(*counts(follow))
    a = sum(follow.values())
    spread = sum(low[min(x, 3)] for x in follow.values()) / a if a else 1.0

    def p1(w):
        return (max(follow[w] - low[min(follow[w], 3)], 0) / a if a else 0) + spread / (n_words + 1)

    def p2(v, w):
        total = sum(ctx[v].values()) if v in ctx else 0
        if not total:
            return p1(w)
        left = sum(high[min(n, 3)] for n in ctx[v].values())
        n = ctx[v][w]
        return max(n - high[min(n, 3)], 0) / total + left / total * p1(w)
    out = {}
    for i, _, t in rows:
        w = words(t)
        out[i] = (len(w), sum(c1[x] > 0 for x in w), n_all,
                  sum(math.log10((c1[x] + 1) / (n_all + n_words + 1)) for x in w),
                  sum(math.log10(p2(v, x)) for v, x in zip([B, *w], w)))
    # the model is a distribution over the words seen and one unseen
    for v in [B, *list(ctx)[:3]]:
        if n_all:
            assert sum(p2(v, x) for x in [*c1, b"\0unseen"]) == pytest.approx(1)
    return out


def check(got, rows):
    want = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = [(r["doc_id"], zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2, r["text"]) for r in docs]
    got = QUERIES["op3_lm_scoring"][0](spark, SF_SMALL).collect()
    check(got, rows)
    assert {r["doc_id"] for r in got if r["held_out"]} == {i for i, y, _ in rows if not y}


def test_many_shards_and_blocks(spark):
    rows = [(i, i % 3 > 0, " ".join(f"W{(i * k) % 17}x" for k in range(i % 40))) for i in range(300)]
    rows += [(1000, True, None), (1001, True, ""), (1002, False, "  \t\n"), (1003, False, "never seen é"),
             (1004, True, "long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, learned boolean, text string").repartition(3)
    df = df.withColumn("score", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = K.fit_and_score(df, F.col("learned"), shard_tokens=2000, block_tokens=900).collect()
    check(got, rows)


def test_no_rows_and_nothing_learned(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert K.fit_and_score(empty, F.lit(True)).collect() == []
    df = spark.createDataFrame([(1, "a b"), (2, None), (None, "a")], "doc_id bigint, text string")
    got = K.fit_and_score(df, F.lit(None).cast("boolean")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["score"], r["base_score"]) for r in got) == [
        (1, 0, 0, 0.0, 0.0), (2, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id bigint, text string")
    got = K.fit_and_score(df, F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in got) == [2, 3, 3] and {r["train_tokens"] for r in got} == {8}


def plain_order(rows, order):
    """rows: (id, learned, text) -> {id: score} of the model of any order."""
    raw = [Counter() for _ in range(order + 1)]
    for _, y, t in rows:
        if y:
            w = [B, *words(t)]
            for k in range(1, order + 1):
                raw[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    raw[1].pop((B,), None)
    counts = [None] * order + [raw[order]]
    for k in range(order - 1, 0, -1):
        left = Counter(g[1:] for g in raw[k + 1])
        counts[k] = Counter({g: n if g[0] == B else left[g] for g, n in raw[k].items()})
    off = [None] + [K.discounts(*(sum(1 for x in c.values() if x == i) for i in (1, 2, 3, 4))) for c in counts[1:]]
    after = defaultdict(Counter)
    for c in counts[1:]:
        for g, n in c.items():
            after[g[:-1]][g[-1]] = n

    def p(context, w):
        k = len(context) + 1
        lower = p(context[1:], w) if context else 1 / (len(raw[1]) + 1)
        total = sum(after[context].values())
        if not total:
            return lower
        left = sum(off[k][min(n, 3)] for n in after[context].values())
        n = after[context][w]
        return max(n - off[k][min(n, 3)], 0) / total + left / total * lower
    out = {}
    for i, _, t in rows:
        w = [B, *words(t)]
        out[i] = sum(math.log10(p(tuple(w[max(j - order + 1, 0):j]), w[j])) for j in range(1, len(w)))
    for context in list(after)[:40]:
        assert sum(p(context, (x)) for x in [*(g[0] for g in raw[1]), b"\0unseen"]) == pytest.approx(1)
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_against_brute_force(spark, order):
    rows = [(i, i % 3 > 0, " ".join(f"W{(i * k * k) % 13 + k % 3}x" for k in range(i % 30))) for i in range(200)]
    rows += [(1000, True, None), (1001, False, ""), (1002, False, "never seen é"), (1003, True, "long " * 3_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, learned boolean, text string").repartition(3)
    want = plain_order(rows, order)
    for size in (1 << 20, 300):           # one shard, several shards
        got = K.fit_and_score(df, F.col("learned"), shard_tokens=size, block_tokens=700, order=order).collect()
        assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(want, rel=1e-9)


def test_only_empty_texts_at_order_three(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    got = K.fit_and_score(df, F.lit(True), order=3).collect()
    assert [r["n_tokens"] for r in got] == [1, 1] and len({r["score"] for r in got}) == 1


def test_no_arrays_stored_that_nothing_reads():
    b = K.block_of([b"a b a b c"], [True])
    x, = b.levels
    runs = K._runs(x.pairs >> 32)
    v, w = x.contexts[(x.pairs >> 32)[runs]], b.words[x.pairs & 0xFFFFFFFF]
    data = K.pack(*K._split40(v), K._small(K.np.diff(runs, append=len(x.pairs))), *K._split40(w), K._small(x.pair_n))
    pairs = list(K.merge_pairs(0, [("pairs", 0, "0-0", data)], 0, 2))
    words = [("words", 0, "0-0", K.pack(b.words, b.word_n)), *(r for r in pairs if r[0] in ("contexts", "follows"))]
    assert {r[0] for r in pairs} == {"pair_n2", "stat2", "contexts", "follows"}
    assert {r[0] for r in K.merge_words(0, words)} == {"word_n2", "stat1"}
