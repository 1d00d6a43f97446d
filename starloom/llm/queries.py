"""Registered queries of the training-data operators, over their whole tables."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, fingerprints, hard_negatives, language, line_dedup, lm, merkle, near_dedup, packing, quality,
               recompression, token_counts, topk)
from .common import id_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Tokens of one packed sequence.
CONTEXT = 2048
#: Least score of a document of good quality.
QUALITY_THRESHOLD = 0.3


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def byte_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"), CONTEXT)


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


ORACLE["op2_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
marked AS (
  SELECT doc_id, line, pos, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped
  FROM keyed)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    model = language.learn(docs, ~held_out)
    return language.predict(docs.select("doc_id", "text"), model) \
        .select("doc_id", held_out.alias("held_out"), "lang_id.lang_pred", "lang_id.score")


@register
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"))


@register
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


ORACLE["op5_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, labels, ~held_out)
    return quality.score(docs.select("doc_id", "text"), model, "score").select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= QUALITY_THRESHOLD, 1).otherwise(0).alias("predicted"))


@register
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), id_bucket(F.col("doc_id"), 5) == 1)


@register
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


@register
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), byte_ranks(), public_tokenizers.PATTERN)


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(
        table(spark, sf_dir, "documents"), byte_ranks(), public_tokenizers.PATTERN)
    return token_counts.histogram(lengths)


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""


@register
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(concat(" + ", ".join(
        f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields) + "))"


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE
crc32_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT range::BIGINT AS b FROM range(256))),
rows AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS stripped,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
           string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 2 = 0 AS tampered
  FROM documents, crc32_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM rows),
up AS (
  SELECT source, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM up
  WHERE n > 1 GROUP BY source, lvl, n, idx // 3),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM up WHERE n = 1),
above AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM above
  WHERE n > 1 GROUP BY lvl, n, idx // 3),
steps AS (
  SELECT l.doc_id, u.lvl, string_agg(u.h, '' ORDER BY u.idx) FILTER (WHERE u.idx < l.idx // power(3, u.lvl)::BIGINT) AS before,
         string_agg(u.h, '' ORDER BY u.idx) FILTER (WHERE u.idx > l.idx // power(3, u.lvl)::BIGINT) AS after
  FROM leaves l JOIN up u ON l.source IS NOT DISTINCT FROM u.source AND u.n > 1
    AND u.idx // 3 = l.idx // power(3, u.lvl + 1)::BIGINT GROUP BY 1, 2
  UNION ALL
  SELECT l.doc_id, 1000 + u.lvl, string_agg(u.h, '' ORDER BY u.idx) FILTER (WHERE u.idx < s.idx // power(3, u.lvl)::BIGINT),
         string_agg(u.h, '' ORDER BY u.idx) FILTER (WHERE u.idx > s.idx // power(3, u.lvl)::BIGINT)
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN above u ON u.n > 1
    AND u.idx // 3 = s.idx // power(3, u.lvl + 1)::BIGINT GROUP BY 1, 2),
paths AS (
  SELECT doc_id, list([coalesce(before, ''), coalesce(after, '')] ORDER BY lvl) AS path,
         string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY lvl) AS siblings FROM steps GROUP BY 1),
fold AS (
  SELECT doc_id, 1 AS k, CASE WHEN tampered THEN stripped ELSE leaf END AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, k + 1, sha256(path[k][1] || h || path[k][2]) FROM fold f JOIN paths p ON f.doc_id = p.doc_id
  WHERE k <= len(path))
SELECT l.doc_id, leaf, subroot, r.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256, f.h AS folded_root,
       f.h = r.h AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
JOIN (SELECT h FROM above WHERE n = 1) r ON TRUE
LEFT JOIN paths p ON l.doc_id = p.doc_id
JOIN fold f ON l.doc_id = f.doc_id AND f.k = coalesce(len(path), 0) + 1
"""


@register
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op13_substring_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents),
starts AS (
  SELECT doc_id, i, words[i:i + 12] AS win FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts)),
earliest AS (SELECT win, min(doc_id) AS least FROM starts GROUP BY win),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM starts JOIN earliest USING (win) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM texts),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS kept FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
