"""Delivered files and their manifests as two streams that wait for each other.

A file and its manifest arrive in any order, some time apart.  A stream-stream join pairs them by name
within a time limit; a file whose manifest has not come in time leaves the join without one, once the
watermark says that none can come any more.  Each micro-batch checks the files it has settled and writes
one verdict per file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.contract import CORRUPT_COLUMN
from tidegate.operators.manifests import verify_files
from tidegate.plans.workspace import new_folder
from tidegate.sources.files import MANIFEST_SCHEMA, file_facts

#: How far apart a file and its manifest may arrive, and how late the listing may show a file.
TIME_LIMIT = "6 hours"
LATENESS = "1 hour"
#: Files that a micro-batch takes up at most.
FILES_AT_ONCE = 1_000


def stream_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    name: Column | None = None,
    arrived: Column | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> DataFrame:
    """``file_path``, ``file_name`` and ``arrived`` (modification time) of new files; no content is read.

    ``name`` and ``arrived`` may be other expressions over ``_metadata``.  Files of zero bytes are not
    seen by a stream: they stay absent for the daily job.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_at_once)
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            (F.col("_metadata.file_name") if name is None else name).alias("file_name"),
            (F.col("_metadata.file_modification_time") if arrived is None else arrived).alias("arrived"),
        )
    )


def stream_manifests(
    spark: SparkSession,
    folder: str,
    pattern: str = "*_manifest.json",
    name: Column | None = None,
    arrived: Column | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> DataFrame:
    """``file_name`` (of the file it is about), ``arrived`` and ``claim`` of new manifests, broken ones too."""
    about = F.regexp_replace(F.col("_metadata.file_name"), "_manifest[.]json$", ".csv")
    read = (
        spark.readStream.schema(f"{MANIFEST_SCHEMA}, {CORRUPT_COLUMN} STRING")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_at_once)
        .json(folder)
    )
    return read.select(
        (about if name is None else name).alias("file_name"),
        (F.col("_metadata.file_modification_time") if arrived is None else arrived).alias("arrived"),
        F.struct(*[c for c in read.columns]).alias("claim"),
    )


def pair_arrivals(
    files: DataFrame, manifests: DataFrame, time_limit: str = TIME_LIMIT, lateness: str = LATENESS
) -> DataFrame:
    """Each file with the ``claim`` of its manifest, or NULL when none has come within the limit.

    Pairs come out at once.  A file alone waits in the state until the watermark, which is ``lateness``
    behind the newest arrival of both sides, has passed its limit.
    """
    wait = F.expr(f"interval {time_limit}")
    left = files.withWatermark("arrived", lateness)
    right = manifests.select(
        F.col("file_name").alias("_about"), F.col("arrived").alias("_claimed_at"), "claim"
    ).withWatermark("_claimed_at", lateness)
    near = (F.col("_claimed_at") >= F.col("arrived") - wait) & (F.col("_claimed_at") <= F.col("arrived") + wait)
    return left.join(right, (F.col("file_name") == F.col("_about")) & near, "left_outer").drop("_about", "_claimed_at")


def _literal(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def dataset_of(path: Column) -> Column:
    """The dataset a file belongs to: the folder it lies in."""
    return F.element_at(F.split(path, "/"), -2)


def start_verification(
    paired: DataFrame,
    verdicts: str,
    checkpoint: str,
    dataset: Column | None = None,
    allow_unhashed: bool = False,
) -> StreamingQuery:
    """Check everything that is settled, then stop; the rest waits in the checkpoint for the next run.

    ``paired`` comes from :func:`pair_arrivals`.  Each micro-batch owns ``batch=<n>`` below ``verdicts``, so
    one that is replayed after a failure overwrites itself.  The paths of one batch are listed on the
    driver, as Spark does for every scan of files.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = new_folder(spark, "arrivals")
        # The join keeps state: it runs once for each batch, into a table that all steps read.
        batch.write.parquet(folder)
        settled = spark.read.schema(batch.schema).parquet(folder)
        paths = [_literal(r.file_path) for r in settled.select("file_path").distinct().collect()]
        if not paths:
            return
        expected = settled.select(
            (dataset_of(F.col("file_path")) if dataset is None else dataset).alias("dataset_name"), "file_name"
        )
        names = settled.select("file_path", "file_name")
        facts = file_facts(spark, paths, "*").drop("file_name").join(names, "file_path")
        claims = settled.where(F.col("claim").isNotNull()).select("file_name", "claim.*")
        verified = verify_files(expected, facts, claims, allow_unhashed=allow_unhashed)
        verified.write.mode("overwrite").parquet(f"{verdicts}/batch={batch_id}")

    return (
        paired.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_verdicts(spark: SparkSession, verdicts: str) -> DataFrame:
    """All verdicts written so far."""
    return spark.read.parquet(verdicts)
