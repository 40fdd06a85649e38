"""SimHash: fingerprints and components against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tickwise.llm import simhash as S
from tickwise.llm.queries import QUERIES


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints):
    p = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= 3
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        root[find(int(i))] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [least[find(i)] for i in range(len(ids))]


def check(spark, rows):
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in S.groups(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    ids = [r[0] for r in rows]
    prints = [plain_fingerprint(r[1]) for r in rows]
    assert got == {i: (p, c) for i, p, c in zip(ids, prints, plain_components(ids, prints))}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in QUERIES["op8_simhash"][0](spark, SF_MID).collect()}
    ids = [r["doc_id"] for r in docs]
    prints = [plain_fingerprint(r["text"]) for r in docs]
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_components(ids, prints))}
    assert len(set(c for _, c in got.values())) < len(ids)


def test_edge_texts(spark):
    long = "wörd Ab\x0bc d " * 70_000
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, long),
                  (8, long), (9, "a b c"), (10, "a b c d e f g")])


def test_links_by_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-2**62, 2**62, 40)
    prints = set(map(int, base))
    for b in base:
        for k in range(1, 6):
            flips = rng.choice(64, size=k, replace=False)
            v = int(b) & (2**64 - 1)
            for f in flips:
                v ^= 1 << int(f)
            prints.add(v - 2**64 if v >= 2**63 else v)
    prints |= {0, -1, 7, 15, -8, -16}
    p = sorted(prints)
    got = {(r["a"], r["b"]) for r in S.links(spark.createDataFrame([(x,) for x in p], "fp bigint")).collect()}
    u = np.array(p, dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3
    assert got == {(p[i], p[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def test_long_chain_is_one_component(spark):
    # each differs from the next in two bits: a path of 30
    p = [sum(1 << (2 * j) | 1 << (2 * j + 1) for j in range(i)) for i in range(31)]
    p = [x - 2**64 if x >= 2**63 else x for x in p]
    pairs = spark.createDataFrame(list(zip(p, p[1:])), "a bigint, b bigint")
    assert {r["root"] for r in S.components(pairs).collect()} == {min(p)}


def test_empty_repeated_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.groups(empty).collect() == []
    rows = [(None, "x y z", 1), (3, "x y z", 2), (3, "x y z", 2), (None, "q r s t", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in S.groups(df).collect())
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3)]


def test_keep_one(spark):
    rows = [(5, "x y z", 1, "a"), (3, "x y z", 2, "b"), (3, "x y z", 2, "b"), (None, "q r s t", 3, None),
            (None, "q r s t", 4, None), (9, None, 5, "c"), (8, "", 6, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _file int, fp string")
    got = S.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in got.collect()) == [-1, 3, 8]


@pytest.mark.parametrize("bits", [-1, 4])
def test_distance_out_of_reach(spark, bits):
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([(1,)], "fp bigint"), bits)
