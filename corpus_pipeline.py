"""Corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``civicscan.llm`` on all its predecessor
kept.  Between stages the documents are written to the folder that the
session's ``spark.checkpoint.dir`` names and read again, so losing executors
costs a retry within a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicscan.llm import langid, line_dedup, packing, simhash
from civicscan.llm.common import documents, materialize
from civicscan.llm.queries import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without letters and
    those of which no language holds a fair share.  ``lang`` stays as given:
    the model learns from it."""
    return langid.keep_identified(docs, langid.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing stays; ``n_chars`` follows the text."""
    out = line_dedup.drop_emptied(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_id), ("dedup_lines", dedup_lines), ("dedup_documents", dedup_documents), ("pack", pack)]

#: SQL can express none of the stages whole (a trained model, winnowing, XXH64, BPE); tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
