"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    alignment,
    decontaminate,
    hashing_index,
    language,
    lempel_ziv,
    licences,
    merkle,
    quality_rules,
    secrets,
    sentencepiece_codec,
    simhash,
    site_style,
    token_counts,
)
from tidegate.llm.shared import crc_remainder, table
from tidegate.plans.workspace import new_folder

MODEL_FILE = "piece_bpe_32k.model"
BYTE_FILE = "byte_bpe_50k.json"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model, keep=["doc_id"]).select(
        "row.doc_id",
        (crc_remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "lang_pred",
        "score",
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = secrets.train(secrets.labelled_samples(docs))
    spans = F.col("spans")
    return secrets.scan(docs, ratios).select(
        "row.doc_id",
        *[secrets.counted(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.described(spans, "assign", "access", "hex"), 256).alias("base_sha256"),
        secrets.described(spans).alias("spans"),
    )


def op3_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_style.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licences.find_licences(docs, licences.known_licences(spark), keep=["doc_id"])
    notices = F.transform("notices", lambda n: F.concat_ws(":", n["line"].cast("string"), n["licence"]))
    return found.select(
        "row.doc_id",
        F.coalesce("whole", F.lit("")).alias("whole_licence"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(notices, ",").alias("notices"),
    )


def op5_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lempel_ziv.duplicate_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", lempel_ziv.n_removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_hashing_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rules = quality_rules.fit(docs.where(crc_remainder(F.col("doc_id"), 4) != 2), labels)
    scored = quality_rules.with_statistics(docs, keep=["doc_id"]).select("row.doc_id", rules.score().alias("score"))
    return scored.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality_rules.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = sentencepiece_codec.encode_decode(docs, public_tokenizers.path(MODEL_FILE), keep=["doc_id"])
    return made.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id", "text"])
    return found.select(
        "row.doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = alignment.aligned(docs, public_tokenizers.path(BYTE_FILE), public_tokenizers.path(MODEL_FILE))
    found = alignment.measures(texts, alignment.pair_counts(texts))
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).alias("groups_sha256")
    digested = found.select(*[c for c in found.columns if c != "groups"], digest)
    made = alignment.without_nulls(alignment.joined(docs, digested, keep=["doc_id"]))
    return made.select("row.doc_id", *[c for c in made.columns if c != "row"])


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lowered = F.translate("text", UPPER, LOWER)
    tampered = F.when(crc_remainder(F.col("doc_id"), 5) == 0, merkle.leaf_digest(*values[:-1], lowered))
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*values).alias("leaf"), tampered.alias("tampered"))
    made = merkle.manifest(leaves, keep=["doc_id", "tampered"])
    found = made.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("row.tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cache = new_folder(spark, "token-counts")
    made = token_counts.count_tokens(docs, public_tokenizers.path(BYTE_FILE), cache, keep=["doc_id"])
    return made.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_language,
            op2_secrets,
            op3_site_style,
            op4_licences,
            op5_lempel_ziv,
            op6_hashing_index,
            op7_quality_rules,
            op8_simhash,
            op9_sentencepiece,
            op10_decontaminate,
            op11_alignment,
            op12_merkle,
            op13_token_counts,
        )
    }
