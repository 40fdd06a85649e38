"""Mixing, WARC, top-k and the pipeline: brute force, round trips, edge cases."""

import hashlib
import json
import math
import re
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_MID, SF_SMALL
from tests.harness import compare, duck
from tickwise.llm import langid, mixing, rules, simhash, topk, warc
from tickwise.llm.queries import QUERIES
from tickwise.session import checkpoint_dir


@pytest.mark.parametrize("name", ["op9_warc", "op10_topk"])
def test_oracle(spark, name):
    fn, sql = QUERIES[name]
    r = compare(spark, duck(SF_MID), SF_MID, name, fn, sql)
    assert r["ok"] and r["spark_rows"] > 0, r


# ---- mixing ------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    for sizes in ([10, 1000, 3], [5, 5, 5, 5], [0, 7], [1]):
        t = mixing.targets(sizes)
        assert sum(t) == pytest.approx(1.5 * sum(sizes)) and all(a <= 2 * s + 1e-9 for a, s in zip(t, sizes))


def test_flow_is_the_cheapest_largest():
    """Against all integer flows of small networks."""
    rng = np.random.default_rng(0)
    for _ in range(25):
        cap = rng.integers(0, 3, 3).tolist()
        members = [sorted(rng.choice(3, rng.integers(1, 3), replace=False).tolist()) for _ in cap]
        quota = rng.integers(0, 5, 3).tolist()
        flow = mixing.min_cost_flow(cap, members, quota)
        into = [0] * 3
        for m, f in zip(members, flow):
            for s, x in zip(m, f):
                assert x >= 0
                into[s] += x
        assert all(x <= q for x, q in zip(into, quota))
        best = max_key = None
        for split in product(*(product(range(5), repeat=len(m)) for m in members)):
            total = [0] * 3
            for m, f in zip(members, split):
                for s, x in zip(m, f):
                    total[s] += x
            if any(sum(f) > 2 * c for f, c in zip(split, cap)) or any(x > q for x, q in zip(total, quota)):
                continue
            cost = sum(max(0, sum(f) - c) for f, c in zip(split, cap))
            key = (sum(total), -cost)
            if max_key is None or key > max_key:
                best, max_key = split, key
        got = (sum(into), -sum(max(0, sum(f) - c) for f, c in zip(flow, cap)))
        assert got == max_key, (cap, members, quota, flow, best)


def check_mix(rows, got):
    """rows: (id, text, source) -> the contract, and the nearest place in each source's order."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    of = defaultdict(int)
    for i, _, s in rows:
        of[s] += size[i]
    names = sorted((s for s in of if s is not None)) + ([None] if None in of else [])
    aim = dict(zip(names, mixing.targets([of[s] for s in names])))
    taken, largest = defaultdict(int), defaultdict(int)
    source = {i: s for i, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], of[s])
        assert r["target"] == pytest.approx(aim[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in names:
        assert abs(taken[s] - aim[s]) <= largest[s] / 2 + 1


def test_mix_query(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = QUERIES["op7_mixing"][0](spark, SF_MID).collect()
    assert len(got) == len(docs)
    check_mix(docs, got)
    again = QUERIES["op7_mixing"][0](spark, SF_MID).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_plans_need_no_python_workers(spark):
    """A plan's rows are handed over as they are, not through Python workers
    that then stay in the executors' memory."""
    p = mixing.Plan({'["a"]': 1, "[null]": 0}, {'["a"]': (1 << 63) - 1, "[null]": -1}, {}, {})
    frame = p.frame(spark)
    assert [tuple(r) for r in frame.collect()] == [('["a"]', 1, (1 << 63) - 1), ("[null]", 0, -1)]
    none = mixing.Plan({}, {}, {}, {}).frame(spark)
    assert none.collect() == [] and none.schema == frame.schema
    assert frame.schema.simpleString() == "struct<pattern:string,passes:int,last_key:bigint>"
    rows = spark.sql("SELECT '[\"a\"]' AS pattern, id AS key, 3L AS size FROM range(9)")
    for f in (frame, none, rows.join(F.broadcast(frame), "pattern")):
        assert "ExistingRDD" not in f._jdf.queryExecution().executedPlan().toString()


def test_mix_edges(spark):
    rows = [(i, "w " * (i % 7), ["a", "b\"é\x01", None, ""][i % 4]) for i in range(60)]
    rows += [(100, None, "a"), (101, "x " * 30_000, None), (102, "", "only empty")]
    schema = "doc_id bigint, text string, source string"
    df = spark.createDataFrame(rows, schema).withColumn("size", F.lit("x")).withColumn("key", F.lit(1))
    check_mix(rows, mixing.mix_sizes(df).collect())
    empty = spark.createDataFrame([], schema)
    assert mixing.mix_sizes(empty).collect() == [] and mixing.mixed(empty).collect() == []
    taken = {r["doc_id"]: (r["taken"] // r["size"] if r["size"] else 0) for r in mixing.mix_sizes(df).collect()}
    got = mixing.mixed(df)
    assert got.columns == df.columns
    n = defaultdict(int)
    for r in got.collect():
        n[r["doc_id"]] += 1
    assert {i: n[i] for i in taken} == taken


def test_overlapping_sources(spark):
    rows = [(json.dumps(p), k, 10) for k, p in enumerate([["a"], ["a", "b"], ["b"], ["a", "b"]] * 50)]
    plan = mixing.plan(spark.createDataFrame(rows, "pattern string, key bigint, size bigint"), weights=(1, 1))
    assert plan.source_size == {"a": 1500, "b": 1500} and plan.target == {"a": 2250.0, "b": 2250.0}
    assert all(n in (1, 2) for n in plan.passes.values())     # 2000 tokens, 4500 wanted, 4000 at most


# ---- WARC --------------------------------------------------------------------------------------


def test_warc_round_trip_and_edges(spark):
    page = "<html>" + "text é " * 50
    rows = [(i, f"http://h/{i} x\r\n", f"{page}{i % 30}") for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "u", "short"), (303, "u", "short"), (5, "again", page + "5"),
             (None, "n", page + "7"), (None, "n", "y" * 200), (400, "long", "z" * 3_000_000), (1, "http://h/1 x\r\n", page + "1")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit(1))
    folder = warc.new_folder(spark)
    got = warc.archive_pages(spark, df, folder).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if h is not None and len(h.encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        refers = first.get(h) if h in first and (i is None or i > first[h]) else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if refers is None else "revisit", refers))
    key = lambda t: tuple((x is None, x or 0) for x in t)
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(want, key=key)
    assert {r["payload"].decode() for r in got if r["payload"] is not None} == {h or "" for _, _, h in rows}


def test_warc_dictionary_frame(spark, tmp_path):
    a = warc.Archive(f"file://{tmp_path}", "x.warc.zst")
    rows = [warc.record(i, f"http://h/{i}", f"<p>common words of page {i % 7}</p>".encode() * 9, "0" * 64, None)
            for i in range(400)]
    for r in rows:
        a.add(r)
    name, n, _ = a.close()
    raw = (tmp_path / name).read_bytes()
    assert n == 400 and raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    with open(tmp_path / name, "rb") as f:
        assert list(warc.records_of(f, 1000)) == rows
    size = int.from_bytes(raw[4:8], "little")
    d = zstandard.ZstdCompressionDict(raw[8:8 + size])
    assert zstandard.ZstdDecompressor(dict_data=d).decompressobj().decompress(raw[8 + size:]).startswith(b"WARC/1.1")
    with open(tmp_path / "cut", "wb") as f:
        f.write(raw[:-5])
    with open(tmp_path / "cut", "rb") as f, pytest.raises(ValueError):
        list(warc.records_of(f))


def test_warc_no_rows(spark):
    assert warc.archive_pages(spark, spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


# ---- top-k -------------------------------------------------------------------------------------


def plain_top_k(rows, k):
    ok = [(i, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % 50 == 0:
            s = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))
            out |= {(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)}
    return out


def test_top_k_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(160)]
    rows += [(200 + i, [0.5] * 8) for i in range(60)]                       # ties
    rows += [(400, None), (401, []), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
             (None, [1.0] * 8), (450, [3.0, 4.0]), (451, [1.0, 1.0]), (500, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    assert got == plain_top_k(rows, 5)
    big = [(i, [float((-1) ** i * (i + 1) * 2 ** 13), 1.0]) for i in range(60)]
    df = spark.createDataFrame(big, "vec_id bigint, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()} == plain_top_k(big, 5)
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []


def test_index_stops_early_and_stays_exact():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(5000, 32)) / 5).astype(np.int64)
    ids = np.arange(5000)
    index = topk.Index(ids, x)
    for q in range(0, 200, 10):
        got, score = index.search(x[q], 5, q)
        s = x @ x[q]
        s[q] = -2**40
        want = np.lexsort((ids, -s))[:5]
        assert got.tolist() == want.tolist() and score.tolist() == s[want].tolist()


# ---- pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    path = f"{checkpoint_dir(spark)}/stages"
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_MID)
        if k < 4:
            assert out.columns == list(rows[0].asDict())
        out.write.mode("overwrite").parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    # language ID: only texts without a main language go
    assert all(re.search(r"[^\W\d_]", rows[i]["text"] or "") for i in kept["language_id"])
    assert len(kept["language_id"]) >= 0.98 * len(rows)
    # rules: nothing that fails the base rules stays
    for i in kept["quality_rules"]:
        n, _, _, _, again = rules.measure(rows[i]["text"])[:5]
        assert n >= 20 and 100 * again <= 30 * n
    # near duplicates: by brute force, one of each group of what the rules kept
    ids = sorted(kept["quality_rules"])
    prints = np.array([simhash.fingerprint((rows[i]["text"] or "").encode()) for i in ids]).view(np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    root = list(range(len(ids)))
    for _ in ids:
        new = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(ids))]
        if new == root:
            break
        root = new
    assert sorted(kept["near_duplicates"]) == sorted({ids[r] for r in root})
    # mix: each kept document at most twice; total near 150 % of the words
    words = {i: len((rows[i]["text"] or "").encode().split()) for i in rows}
    total = sum(words[i] for i in kept["near_duplicates"])
    assert max(kept["mix"].count(i) for i in set(kept["mix"])) <= 2
    assert abs(sum(words[i] for i in kept["mix"]) - 1.5 * total) < 0.1 * total
    assert sorted(kept["tokens"]) == sorted(kept["mix"])


def test_pipeline_edges(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} of it" for i in range(60))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, text, "en", None, 9), (3, text, "en", None, 9),
            (None, text + " more words here", "en", "b", 9), (9, text, None, "a", None)]
    docs = spark.createDataFrame(rows, schema).withColumn("score", F.lit(1)).withColumn("key", F.lit("k"))
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), SF_SMALL)
        assert empty.collect() == []
        docs = stage(spark, docs, SF_SMALL)
        if k < 4:
            assert docs.columns == columns
        if k == 2:
            # the rows 3, 3 and 9 are one text; the text with further words is another
            assert {r["doc_id"] for r in docs.collect()} == {3, None} and docs.count() == 2
    assert langid.UNDETERMINED not in [r["doc_id"] for r in docs.collect()]


def test_pipeline_query(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


# ---- sizes that used to change the method ------------------------------------------------------


def test_every_archive_has_a_dictionary(tmp_path):
    """One short record, fifteen, and some of 200 KB: a leading skippable
    frame, and the records come back."""
    rng = np.random.default_rng(2)
    long = [bytes(rng.integers(97, 123, 200_000, dtype=np.uint8)) for _ in range(3)]
    cases = [[b"WARC/1.1 x"], [b"WARC/1.1 %d " % i + b"ab" * 40 for i in range(15)], long, [b"a"] * 40, [b""] * 3 + [b"z"]]
    for n, records in enumerate(cases):
        a = warc.Archive(f"file://{tmp_path}", f"{n}.warc.zst")
        for r in records:
            a.add(r)
        a.close()
        raw = (tmp_path / f"{n}.warc.zst").read_bytes()
        magic, size = np.frombuffer(raw[:8], "<u4").tolist()
        assert magic == warc.SKIPPABLE and 0 < size <= warc.DICTIONARY_BYTES
        packer = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
        got = packer.stream_reader(raw[8 + size:], read_across_frames=True).read()
        assert got == b"".join(records)


def test_topk_large_components(spark):
    """Finite components up to a long's ends are scored exactly, beside rows
    that the index answers."""
    rows = [(i, [float(i % 7), 1.0 - i]) for i in range(120)] + [(200, [-1e17, 2.0]), (201, [1e17, 1.0]), (250, [0.5, -3e15])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    ints = {i: [max(-2**63, min(2**63 - 1, math.floor(256 * c))) for c in v] for i, v in rows}
    for q in (i for i in ints if i % 50 == 0):
        scores = {i: sum(a * b for a, b in zip(ints[q], v)) for i, v in ints.items() if i != q}
        want = sorted(scores, key=lambda i: (-max(-2**63, min(2**63 - 1, scores[i])), i))[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[1] for r in mine] == want
        assert [r[2] for r in mine] == [max(-2**63, min(2**63 - 1, scores[i])) for i in want]


def test_mixtures_and_corpora_without_languages_stay(spark):
    """A text of several identified languages stays, and where none can be
    learned, each text with a letter."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    by_lang = {r.lang: r.text for r in docs.where("lang IS NOT NULL AND length(text) > 2000").collect()}
    mixed = "\n".join(by_lang[x][:n] for x, n in zip(sorted(by_lang), (900, 750, 700, 650)))
    frame = spark.createDataFrame([(1, mixed), (2, "12 34"), (3, None), (4, "")], "doc_id bigint, text string")
    model = langid.train(docs, F.lit(True))
    assert [r.doc_id for r in langid.keep_identified(frame, model).collect()] == [1]
    assert len(langid.predict(frame, model).where("doc_id = 1").first().languages) == 4
    none = langid.train(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert [r.doc_id for r in langid.keep_identified(frame, none).collect()] == [1]
