"""The queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.llm import (decontam, exact_dedup, hard_negatives, langid, line_dedup, packing, quality_knn,
                           simhash_dedup, substring_dedup, token_store, toxicity, warc, whitening)
from civicmart.llm.common import read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(read_table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(read_table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.quality(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted, error = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    share = F.array(*map(F.lit, fitted.explained)).cast("array<double>")  # one number a component
    return (rows.withColumn("explained", share)
            .select("key", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "w"))
            .select(F.col("key").alias("vec_id"), (F.col("k") + 1).cast("int").alias("component"),
                    F.lit(fitted.n).cast("long").alias("n"), "deviation", "w.whitened", "w.explained",
                    F.lit(error).cast("double").alias("identity_error")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


# DuckDB writes the white space class as an RE2 class; chr(11) and chr(12) need \x escapes.
_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3_SQL = rf"""
WITH lines AS (
  SELECT doc_id, pos, line, {_LOWER.format(f"regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g')")} AS k
  FROM (SELECT doc_id, parts, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
owners AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.doc_id, l.pos, l.line, o.owner IS NOT NULL AND o.owner <> l.doc_id AS gone
  FROM lines l LEFT JOIN owners o USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP10_SQL = rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS t
  FROM documents),
w AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM w
"""

# A window is its 13 words joined by spaces; words hold none.
_OP11_SQL = rf"""
WITH w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '{_SPACE}+') if x <> ''] AS ws
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
firsts AS (SELECT k, min(doc_id) AS owner FROM wins GROUP BY k HAVING min(doc_id) <> max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + j AS pos
  FROM wins JOIN firsts USING (k), (SELECT unnest(range(13)) AS j) WHERE owner < doc_id),
words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


_OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(c AS DOUBLE)) for c in embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS label, r.vec_id AS other, r.label AS other_label,
         CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM s WHERE label = other_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id)
WHERE label <> other_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_language_id, op2_toxicity, op3_line_dedup, op4_warc, op5_decontamination, op6_packing,
        op7_token_store, op8_simhash_dedup, op9_quality, op10_exact_dedup, op11_substring_dedup,
        op12_embedding_whitening, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": _OP3_SQL, "op10_exact_dedup": _OP10_SQL,
            "op11_substring_dedup": _OP11_SQL, "op13_hard_negatives": _OP13_SQL}
