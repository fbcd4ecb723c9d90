"""Delivered CSV files as all-string frames, one frame per distinct header."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import CORRUPT_COLUMN
from tidegate.operators.enforce import SOURCE_COLUMN
from tidegate.sources.files import decoded_path
from tidegate.sources.zones import is_folder

DATA_FILES = "*.csv"


def list_files(spark: SparkSession, path: str, pattern: str = DATA_FILES) -> list[str]:
    """Paths of the data files under ``path``: names only, no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return sorted(r["p"] for r in files.select(F.col("path").alias("p")).collect())


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names on the first line of a file."""
    return spark.read.option("header", True).csv(path).columns


def first_lines(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """``file_path`` and ``line``, the first one, of every file: one job, however many files there are.

    Spark's text scan has no way to stop after a line, so the files are read through once more.
    """
    reader = spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    lines = reader.text(paths if isinstance(paths, str) else list(paths)).select(
        meta["file_path"].alias("file_path"),
        meta["file_block_start"].alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    # Lines of a split are numbered in their order.
    return lines.where("start = 0").groupBy("file_path").agg(F.min_by("line", "place").alias("line"))


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: Iterable[str],
    check_headers: bool = True,
    pattern: str | None = None,
) -> DataFrame:
    """Files that share ``header``, every column as text, plus the corrupt-record column and the
    file each row came from.

    Short, long and unbalanced rows set the corrupt-record column.  Column pruning is off for
    this scan because Spark only notices such rows when it parses every column.  With
    ``check_headers`` a file whose header differs fails the scan instead of shifting its values
    into other columns.
    """
    fields = [T.StructField(n, T.StringType()) for n in [*header, CORRUPT_COLUMN]]
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", not check_headers)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("columnPruning", False)
    )
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    scanned = reader.csv(paths if isinstance(paths, str) else list(paths))
    return scanned.select("*", F.col("_metadata.file_path").alias(SOURCE_COLUMN))


def _is_many(spark: SparkSession, path: str) -> bool:
    return any(c in path for c in "*?[{") or is_folder(spark, path)


def _literal(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_landing(
    spark: SparkSession, paths: str | Sequence[str], uniform_header: bool = False
) -> list[DataFrame]:
    """All-string frames for the delivered files, one per distinct header (column order counts).

    A folder or pattern stands for the data files it holds.  The header of every file is read, by one
    job for all; values belong to the name above them, whatever the order.  Where all files have one
    header, only that comes to the driver; else the paths of each header's files do.  With
    ``uniform_header`` only the first file is looked at and Spark itself refuses a file that deviates,
    which saves the pass over very large deliveries written by one job.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    if uniform_header:
        first = list_files(spark, given[0]) if _is_many(spark, given[0]) else given
        return [scan_csv(spark, given, read_header(spark, first[0]))]
    many = [p for p in given if _is_many(spark, p)]
    single = [p for p in given if p not in many]
    tables = [first_lines(spark, many, DATA_FILES)] if many else []
    tables += [first_lines(spark, single)] if single else []
    lines = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    found = lines.select("line", decoded_path(F.col("file_path")).alias("file_path"))
    headers = found.groupBy("line").agg(F.min("file_path").alias("sample"), F.count("*").alias("files")).collect()
    if not headers and single:
        # Files without a line have no columns, which the contract then misses.
        return [scan_csv(spark, single, [], False)]
    if not headers:
        raise FileNotFoundError(f"no data files in {given}")
    names = {r.line: tuple(read_header(spark, _literal(r.sample))) for r in headers}
    if len(headers) == 1 and not (many and single):
        return [scan_csv(spark, given, names[headers[0].line], False, DATA_FILES if many else None)]
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found.orderBy("file_path").collect():
        groups.setdefault(names[row.line], []).append(_literal(row.file_path))
    return [scan_csv(spark, members, header, False) for header, members in groups.items()]
