"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicscan.llm import (bpe, embed_dedup, langid, licenses, line_dedup, order_minhash, packing, page_text, sharding, simhash,
                           spelling, toxicity, whitening)
from civicscan.llm.common import documents, table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on the driver."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.fit(docs)).withColumnRenamed("id", "doc_id")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(documents(spark, sf_dir))
    text = F.col("record.text")
    return out.select("record.doc_id", sharding.size_of("record.text").alias("size"),
                      F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_language_id": op3_language_id,
    "op4_order_minhash": op4_order_minhash,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_bpe": op7_bpe,
    "op8_simhash": op8_simhash,
    "op9_page_text": op9_page_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_toxicity": op12_toxicity,
    "op13_embedding_whitening": op13_embedding_whitening,
}

# crc32 by its table, which follows from the polynomial; near words by deleting a character on both sides or on one
_SPELLING = """
WITH RECURSIVE bits AS (
  SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))),
low AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
runs AS (SELECT d, unnest(regexp_extract_all(t, '[a-zÀ-ÿ]{7,}')) AS w FROM low),
one AS (SELECT w, count(*) AS k, list_transform(regexp_extract_all(hex(encode(d || ':' || w)), '..'), lambda x : CAST('0x' || x AS BIGINT)) AS bytes
  FROM runs GROUP BY d, w),
hashed AS (SELECT w, k, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x : xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM one, bits),
cut AS (SELECT k, CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word
  FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
gaps AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
skip AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM gaps),
near AS (
  SELECT a.word, b.word AS other, b.n FROM skip a JOIN skip b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM skip s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM skip s JOIN words w ON s.rest = w.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
forms AS (SELECT b.word, min(r.other) AS form, b.top AS form_n FROM best b JOIN words w ON w.word = b.word
  JOIN near r ON r.word = b.word AND r.n = b.top WHERE b.top >= 10 * w.n GROUP BY b.word, b.top),
chain AS (SELECT word, form AS tip, 1 AS step FROM forms
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.tip),
ends AS (SELECT word, arg_max(tip, step) AS root FROM chain GROUP BY word)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN ends e ON e.word = w.word
"""

ORACLE_SQL: dict[str, str] = {"op11_spelling_variants": _SPELLING}
