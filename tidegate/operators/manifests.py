"""Check every expected file against what arrived and what its manifest claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.contract import CORRUPT_COLUMN

CHECKS = [
    "file_arrived", "filename_pattern", "manifest_present", "manifest_parseable",
    "checksum_match", "row_count_match", "file_size_match",
]


def delivery_pattern(dataset: Column) -> Column:
    """Pattern of a delivered file's name: the dataset, a date of eight digits, ``.csv``."""
    return F.concat(F.lit(r"^\Q"), dataset, F.lit(r"\E_\d{8}\.csv$"))


def _outcome(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def verify_files(
    expected: DataFrame,
    facts: DataFrame,
    manifests: DataFrame,
    pattern: Column | None = None,
    allow_unhashed: bool = False,
) -> DataFrame:
    """One row per expected file (``dataset_name``, ``file_name``) with the outcome of every check.

    A check that could not run because an earlier one failed is NULL: nothing can be said about a
    file that is not there, nor compared with a manifest that is missing or broken.  ``passed``
    is true when nothing failed; ``errors`` says what did.  A file that could not be hashed has the
    outcome SKIPPED against a claimed checksum and does not pass, unless ``allow_unhashed``.
    """
    pattern = delivery_pattern(F.col("dataset_name")) if pattern is None else pattern
    given = manifests.select(
        "file_name",
        F.coalesce("checksum", F.lit("")).alias("_checksum"),
        F.coalesce("expected_rows", F.lit(-1)).alias("_rows"),
        F.coalesce("file_size_bytes", F.lit(-1)).alias("_size"),
        F.col(CORRUPT_COLUMN).isNull().alias("_parseable"),
    )
    joined = expected.join(facts, "file_name", "left").join(given, "file_name", "left")

    arrived = F.col("file_path").isNotNull()
    present = F.col("_parseable").isNotNull()
    comparable = arrived & present & F.col("_parseable")
    pairs = {
        "checksum_match": (F.col("_checksum"), F.col("checksum")),
        "row_count_match": (F.col("_rows"), F.col("data_rows")),
        "file_size_match": (F.col("_size"), F.col("file_size_bytes")),
    }
    outcomes = {
        "file_arrived": _outcome(arrived),
        "filename_pattern": F.when(arrived, _outcome(F.regexp_like(F.col("file_name"), pattern))),
        "manifest_present": F.when(arrived, _outcome(present)),
        "manifest_parseable": F.when(arrived & present, _outcome(F.col("_parseable"))),
    }
    for name, (claimed, actual) in pairs.items():
        outcomes[name] = F.when(comparable, _outcome(claimed.eqNullSafe(actual)))
    # A file whose storage does not let it be hashed is neither right nor wrong.
    unhashed = comparable & F.col("checksum").isNull() & (F.col("_checksum") != "")
    outcomes["checksum_match"] = F.when(unhashed, "SKIPPED").otherwise(outcomes["checksum_match"])
    details = {
        "file_arrived": F.lit("file not found"),
        "filename_pattern": F.concat(F.lit("name does not match "), pattern),
        "manifest_present": F.lit("manifest not found"),
        "manifest_parseable": F.lit("manifest is not valid JSON"),
    }
    for name, (claimed, actual) in pairs.items():
        details[name] = F.concat(
            F.lit("expected="), claimed.cast("string"), F.lit(", actual="), F.coalesce(actual.cast("string"), F.lit("none"))
        )
    judged = joined.select("*", *[outcomes[c].alias(c) for c in CHECKS])
    bad = ["FAIL"] if allow_unhashed else ["FAIL", "SKIPPED"]
    errors = F.array_compact(
        F.array(*[F.when(F.col(c).isin(bad), F.concat(F.lit(f"{c}: "), details[c])) for c in CHECKS])
    )
    return judged.select(
        "dataset_name", "file_name", "file_path", *CHECKS, errors.alias("errors")
    ).withColumn("passed", F.size("errors") == 0)


def passing_files(verified: DataFrame) -> DataFrame:
    """Paths that may be ingested."""
    return verified.where("passed").select("dataset_name", "file_path")


def failures_per_file_check(verified: DataFrame) -> DataFrame:
    """Files per check and outcome; outcome NULL means the check could not run."""
    return (
        verified.unpivot(["file_name"], CHECKS, "check_name", "outcome")
        .groupBy("check_name", "outcome")
        .agg(F.count("*").alias("files"))
    )
