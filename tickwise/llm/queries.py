"""The registered queries of this package: name -> (query, DuckDB SQL or None).

Each query is thin: it calls its operator over the whole table with
production parameters and derives the digest columns from its outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import bpe, interactions, kneser_ney, langid, licenses, mixing, nbsvm, pii, rules, simhash, topk, warc, whitening
from tickwise.llm.common import labels_of, remainder_is, table
from tickwise.session import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


@register("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_is("doc_id", 5, 0)
    return (langid.predict(docs, langid.train(docs, ~held_out))
            .withColumn("held_out", held_out)
            .select("doc_id", "held_out", "lang_pred", "score", "languages"))


@register("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_is("doc_id", 5, 0)
    labels = labels_of(table(spark, sf_dir, "labels"), "quality").where(~held_out)
    return (nbsvm.score(docs, nbsvm.train(docs, labels))
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


@register("op3_lm_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder_is("doc_id", 7, 2)
    return (kneser_ney.fit_and_score(table(spark, sf_dir, "documents"), ~held_out)
            .withColumn("held_out", ~F.col("learned"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


@register("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(rules.statistics(table(spark, sf_dir, "documents")), "rule_stats")
    learned = rules.learn_from(stats, labels_of(table(spark, sf_dir, "labels"), "quality"))
    return (stats.withColumn("rule", rules.verdict(learned))
            .withColumn("base_failed", rules.base_failed())
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"),
                    "rule"))


@register("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@register("op6_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.round_trip(docs, bpe.compile_merges(TOKENIZER))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


@register("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register("op9_warc", """
  WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
      sha256(coalesce(html, '')) AS payload_digest FROM pages),
  f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
  SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END
      AS record_type,
    CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
  FROM p LEFT JOIN f USING (payload_digest)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_pages(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_topk", """
  WITH e AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
  s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
  SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op11_pii")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


@register("op12_filter_interactions", r"""
  WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  f AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
  l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
    FROM labels GROUP BY doc_id),
  m AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN d.doc_id IS DISTINCT FROM f.first THEN 'E' ELSE '' END AS mask
    FROM d JOIN f USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
  c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
  k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM k a, k b, k c, k d, k e
    WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
  s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS x, substr(filter_order, 1, i - 1) AS earlier
    FROM o, range(1, 6) r(i)),
  r AS (
    SELECT part, filter_order, step, x,
      sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (NOT gone AND fails) AS removed,
      sum(n) FILTER (gone AND fails) AS redundant, sum(n) FILTER (mask = x) AS unique_fails,
      sum(good) FILTER (NOT gone AND fails) AS good_lost, sum(toxic) FILTER (NOT gone AND fails) AS toxic_lost
    FROM (SELECT *, contains(mask, x) AS fails, length(translate(mask, earlier, '')) < length(mask) AS gone FROM c, s)
    GROUP BY ALL)
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
    CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
    CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
  FROM r""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(interactions.failure_masks(table(spark, sf_dir, "documents"),
                                                         table(spark, sf_dir, "labels")))


@register("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
