"""The registered ``opN_*`` queries: each applies its operator, with the
parameters of its contract, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm import (
    decontaminate,
    language_id,
    minhash_dedup,
    mixing,
    negative_mining,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    url_filter,
)

#: the rules of the URL query
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("__q")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules.judge(_table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", *[q[c].alias(c) for c in names], F.col("__q_failed").alias("base_failed"),
        F.col("__q_kept").alias("kept"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"), length=100)


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), repeat_limit=2.0)
    return d.groupBy("doc_id", "source").agg(F.count("*").alias("copies"), F.max("mix_epoch").alias("last_epoch"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(_table(spark, sf_dir, "documents"), length=35)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.report(_table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count_col="n_replaced")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negative_mining.mine(_table(spark, sf_dir, "embeddings"), lambda ids: ids % 50 == 0, label=label)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf_dir, "documents"), rule=spelling_variants.drop_by_crc(199))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_suffix_array_dedup, op3_mixing_sources, op4_substring_dedup, op5_minhash_near_dedup,
    op6_quality_classifier, op7_benchmark_decontamination, op8_url_filters, op9_language_id, op10_pii,
    op11_hard_negatives, op12_packing, op13_spelling_variants)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 8) u),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)),
cov AS (SELECT doc_id, count(*) AS n FROM pos GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
q AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id)),
j AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
        OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words AS base_failed FROM q),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS f FROM j
      WHERE source IS NOT NULL AND source <> '' GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS m, sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v
      FROM h),
k AS (SELECT m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS k FROM m),
r AS (SELECT source, (f + k * m) / (n + k) AS rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(rate > {quality_rules.HOST_MAX_RATE}, false)
    AND (100 * n_repeat_words > {quality_rules.STRICT_REPEAT_PCT} * n_words
         OR 100 * n_symbols > {quality_rules.STRICT_SYMBOL_PCT} * word_chars OR n_dup_lines > 0)) AS kept
FROM j LEFT JOIN r USING (source)""",
    "op4_substring_dedup": rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) > 34) u),
twice AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN twice USING (g)),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
        CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
