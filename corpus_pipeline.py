"""Raw documents to token ids: quality, near duplicates, benchmark leaks, secrets, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next one's documents.  All but the last return the columns of ``documents``.  Each
operator states what it does with NULLs, empty and repeated rows and extra columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, quality_rules, secrets, sentencepiece_codec, simhash
from tidegate.llm.queries import MODEL_FILE
from tidegate.llm.shared import crc_remainder, table, written

#: SQL can't express the classifier's fit, XXH64 fingerprints or the tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; rejected ones go."""
    rules = quality_rules.fit(docs.where(crc_remainder(F.col("doc_id"), 4) != 2), table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Groups are those of query 8; what they miss at shingle similarity 0.8 is in the README.
    """
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; contaminated ones go whole."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and n_chars brought up to date."""
    return secrets.mask_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the end id, and whether decoding gives the text back, of every document."""
    made = sentencepiece_codec.encode_decode(docs, public_tokenizers.path(MODEL_FILE), keep=docs.columns)
    return made.select(
        "row.doc_id",
        "row.lang",
        "row.source",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"),
        "ids",
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", mask_secrets),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
