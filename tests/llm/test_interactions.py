"""Filter interactions against applying the filters one after the other."""

import re
from itertools import permutations

from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from tickwise.llm import interactions as I

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("mask", T.IntegerType()),
                     T.StructField("digest", T.StringType())])
LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Plain Python from the definition: one order and filter at a time."""
    docs = [(d[0], d[1] or "", d[2] or "") for d in docs]
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}

    def fails(d):
        i, t, _ = d
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        ids = [e[0] for e in docs if e[1] == t and e[0] is not None]
        return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t),
                "E": bool(ids) and (i is None or min(ids) < i)}

    rows = {}
    for part in {d[2] for d in docs}:
        own = [(d, fails(d)) for d in docs if d[2] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                total = sum(x[1][f] for x in own)
                rows[part, order, step] = [
                    len(left), len(gone), total - len(gone), sum(x[1][f] and sum(x[1].values()) == 1 for x in own),
                    sum(x[0][0] in good for x in gone), sum(x[0][0] in toxic for x in gone)]
    shapley = {}
    for (part, order, step), r in rows.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + r[1]
    return {k: (*r, shapley[k[0], k[1][k[2] - 1]]) for k, r in rows.items()}


def found(spark, docs, labels):
    out = I.audit(I.failure_masks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)))
    rows = out.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_against_brute_force(spark):
    """Null, empty and long texts, copies over parts, repeated and null ids,
    contradicting labels, documents' columns named like inner ones."""
    long = " ".join(f"word{i}" for i in range(20000))
    many = " ".join(f"w{i}" for i in range(60))
    rest = ["x", None]
    docs = [(1, None, "a"), (2, "", "b"), (3, many, None), (4, many, "a"), (4, many, "a"), (4, many, ""), (5, long, "a"),
            (6, long + " #", "a"), (7, "AB " * 50, "b"), (8, many.upper(), "a"), (None, many, "b"), (None, "only", "b"),
            (None, "only", "b"), (9, "é" * 30 + " É", "c"), (10, "  \x85  x", "c"), (11, "x$", "c"), (3, many, None)]
    docs = [(*d, 1, rest[0]) for d in docs]
    labels = [(3, 1, 0), (3, 0, 0), (4, 1, 1), (7, 0, 1), (None, 1, 1), (8, None, 1), (99, 1, 1)]
    assert found(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert found(spark, [], []) == {}
    assert len(found(spark, [(1, "a", "s", 0, "")], [])) == 600


def test_every_order_by_single_swaps():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in I.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(permutations(range(n))))


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.tuples(st.integers(0, 9)), min_size=1))
def test_swaps_keep_the_diagram_equal_to_one_built_in_that_order(counts):
    diagram = I.Diagram(counts, "ABCD")
    for level in I.adjacent_swaps(4):
        diagram.swap(level)
        bits = ["ABCD".index(f) for f in diagram.order]
        moved = {}
        for mask, w in counts.items():
            moved[sum(1 << i for i, b in enumerate(bits) if mask >> b & 1)] = w
        anew = I.Diagram(moved, "".join(diagram.order))
        assert [n.weight for n in diagram.all_pass()] == [n.weight for n in anew.all_pass()]
        assert [len(x) for x in diagram.levels] == [len(x) for x in anew.levels]
