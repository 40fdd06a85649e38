"""Personal data: base spans and label model against plain Python."""

import hashlib
import math
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from tickwise.llm import pii
from tickwise.llm.queries import op11

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("base", T.IntegerType()), T.StructField("s", T.IntegerType()),
                     T.StructField("kept", T.IntegerType())])
GOOD, SECOND, BAD = "4041894974608795", "4337166598464399", "4041894974608796"


def luhn(digits):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def accepted(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in span.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if accepted(k, m.group())]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)], DOCS)


def found(spark, texts):
    out = pii.find(frame(spark, texts))
    assert out.columns == ["doc_id", "text", "s", "kept", "base", "added"]
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    name = lambda spans: [(pii.KINDS[s.kind], s.start, s.end) for s in spans]
    assert len(rows) == len(texts)
    return [(name(r["base"]), name(r.added)) for r in rows]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op11(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = base_spans(docs[r.doc_id])
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
        got = [x for x in r.spans.split(",") if x]
        assert set(listed) <= set(got)
        assert got == sorted(got, key=lambda x: (list(BASE).index(x.split(":")[0]), int(x.split(":")[1])))


def test_odd_texts(spark):
    """Null, empty, repeated and very long texts, code points beyond 16 bits,
    runs that would make patterns recurse or start over at each letter."""
    texts = [None, "", "a@b.c", "a@b.c", "x\U0001F600é a@b.c, 1.2.3.4 \U0001F600 +1 (918) 555-3922!", "1.2.3.4.5.6.7.8",
             "256.1.1.1 1.256.1.1 000255.1.1.1 1.1.1.2555", "a@b.c%d@e.f-@g.h..i@j.k", "+1+1 234 5678+12", "a" * 8_000,
             "7" * 8_000, "a@b" + ".c" * 50_000, "1.1.1.1 " * 30_000, "mail4@x.org " * 5_000, "4" * 17 + " -5",
             f"{GOOD} 17 {GOOD[:4]}-{GOOD[4:8]}-{GOOD[8:12]}-{GOOD[12:]}", f"{GOOD}5{SECOND}", "+1" + " " * 50_000,
             "+1 (918) 555-3922\n+49 30 1234567", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", ".@-.-. a.@b-.c", "\x85+٣ 123 456"]
    got = found(spark, texts)
    for t, (spans, _) in zip(texts, got):
        assert spans == base_spans(t)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="a1-.@+ (4)é\n9", max_size=60), min_size=40, max_size=40))
def test_random_texts(spark, texts):
    assert [spans for spans, _ in found(spark, texts)] == [base_spans(t) for t in texts]


def test_added_spans(spark):
    """What a neighbour swallows is found again; numbers without a valid check
    digit, serials and plain texts are left alone, base spans stay."""
    plain = [f"word {i}" for i in range(20)]
    cases = [f"{GOOD} {SECOND} x", f"+1 (918) 555-3922 {GOOD} x", f"1.2.3.4 {GOOD}", f"{BAD} {BAD} x", f"token {BAD}99",
             "write to jane [at] mail (dot) example [dot] com now", "call (918) 555-3922 now", f"serial id={SECOND}"]
    got = found(spark, [*cases, *plain, *[f"pay {GOOD} or {BAD} or call +1 (918) 555-3922"] * 50])
    text = lambda i: [(k, cases[i][a:b]) for k, a, b in got[i][1]]
    assert text(0) == [("card", GOOD), ("card", SECOND)]
    assert text(1) == [("card", GOOD), ("phone", "+1 (918) 555-3922")]
    assert text(2) == [("card", GOOD)]
    assert text(3) == text(4) == []
    assert text(6) == [("phone", "(918) 555-3922")]
    assert got[7][0] == [("card", 10, 26)]
    assert all(g == ([], []) for g in got[len(cases):len(cases) + 20])
    assert all(len(g[0]) == 2 and g[1] == [] for g in got[len(cases) + 20:])


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [None, "nothing"]) == [([], []), ([], [])]


def test_running_values_over_blocks(spark):
    for n in (0, 1, pii.BLOCK - 1, pii.BLOCK, 3 * pii.BLOCK + 7):
        xs = F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>")
        row = spark.range(1).select(pii.prefixes(xs, F.lit(0), lambda v, x: v + x).alias("s"),
                                    pii.prefixes(F.reverse(xs), F.lit(-1), F.greatest).alias("m")).first()
        assert row.s == [i * (i + 1) // 2 for i in range(n + 1)]
        assert row.m == [-1] + [n] * n


def test_places_of_many_matches(spark):
    text = " ".join(f"u{i}@h{i}.org x{'y' * (i % 7)}" for i in range(2_000))
    assert found(spark, [text])[0][0] == base_spans(text)


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.text(alphabet="yn-", min_size=6, max_size=6), st.integers(1, 40), min_size=1, max_size=8))
def test_estimates_against_a_loop_over_single_candidates(counts):
    model = pii.estimate(counts)
    votes = [p for p, n in counts.items() for _ in range(n)]
    prior = [pii.PRIOR.get(x, 0.7) for x in pii.LABELERS]
    share, rel = 0.5, list(prior)

    def chance(p):
        yes, no = share, 1 - share
        for v, r in zip(p, rel):
            if v != "-":
                yes *= r if v == "y" else 1 - r
                no *= 1 - r if v == "y" else r
        return yes / (yes + no)

    for _ in range(pii.ROUNDS):
        likely = [chance(p) for p in votes]
        n = len(votes)
        share = (sum(likely) + 0.5 * (n + 1)) / (2 * n + 1)
        for j, r in enumerate(prior):
            hits = [(q if p[j] == "y" else 1 - q) for p, q in zip(votes, likely) if p[j] != "-"]
            rel[j] = min(max((r * (n + 1) + sum(hits)) / (n + 1 + len(hits)), 1e-3), 1 - 1e-3)
    assert model.share == pytest.approx(share, abs=1e-6)
    assert [model.reliability[x] for x in pii.LABELERS] == pytest.approx(rel, abs=1e-6)
    for p in counts:
        assert model.likelihood(p) == pytest.approx(chance(p), abs=1e-6)


def test_reliabilities_are_learned():
    """A labeler that contradicts the others falls, one that agrees rises."""
    model = pii.estimate({"yy--y-": 400, "yyn-y-": 500, "nn-ynn": 300, "nnyynn": 600})
    assert model.reliability["rule"] > 0.95 and model.reliability["gazetteer"] < 0.6
    assert model.reliability["left_context"] < 0.6
    assert model.likelihood("yyn-y-") > 0.9 > 0.1 > model.likelihood("nnyynn")


def test_classifier_is_at_the_least_loss():
    rows = [("101", 8.0, 10.0), ("001", 1.0, 20.0), ("110", 30.0, 31.0), ("010", 2.5, 5.0)]
    w = pii.logistic(rows, ridge=0.1)

    def loss(w):
        total = 0.05 * sum(x * x for x in w)
        for f, ones, n in rows:
            z = w[0] + sum(x for x, b in zip(w[1:], f) if b == "1")
            total += n * math.log1p(math.exp(z)) - ones * z
        return total

    for i in range(len(w)):
        for d in (-1e-3, 1e-3):
            assert loss(w) <= loss([x + d * (j == i) for j, x in enumerate(w)])


def test_no_python_on_the_executors(spark):
    plan = pii.find(frame(spark, ["a@b.c"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
