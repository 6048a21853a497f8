"""The queries of this subpackage and, where SQL can say it, the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderframe.llm import fingerprints, language_model, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, sharding, warc
from cinderframe.llm.common import table

SHARDS = 40


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.col("target"), "taken", "source")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_near_dedup, op3_pii, op4_fingerprints, op5_language_model, op6_warc, op7_packing, op8_quality_rules, op9_mixing, op10_quality_classifier)}

# The verdict doesn't depend on the order of the rules, so SQL can state it: the base, and no rule rejects.
ORACLE_SQL = {
    "op8_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
c AS (SELECT doc_id, t, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines FROM w),
g AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM m) GROUP BY doc_id),
b AS (SELECT c.*, coalesce(r.n, 0)::BIGINT AS n_repeat_words, n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed FROM c LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_symbols > 0.2 * n_words OR length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 0.4 * word_chars
         OR length(regexp_replace(t, '[^!?]+', '', 'g')) > 0.3 * n_words OR word_chars > 20 * n_words OR n_dup_lines > 0.5 * lines) AS kept
FROM b""",
    "op6_warc": r"""
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS p, sha1(coalesce(html, '')) AS h FROM pages),
hex AS (SELECT page_id, octet_length(p)::BIGINT AS n, h, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', h[i + 1]) - 1) AS x FROM d),
bits AS (SELECT page_id, n, h, flatten(list_transform(x, lambda v: [(v >> 3) & 1, (v >> 2) & 1, (v >> 1) & 1, v & 1])) AS b FROM hex),
enc AS (SELECT page_id, n, h, array_to_string(list_transform(range(0, 32), lambda i: ('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[(16 * b[5 * i + 1] + 8 * b[5 * i + 2] + 4 * b[5 * i + 3] + 2 * b[5 * i + 4] + b[5 * i + 5] + 1)::INT]), '') AS digest FROM bits),
last AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM enc)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM last""",
}
