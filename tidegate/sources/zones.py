"""Reading what the zones hold."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_partition(
    spark: SparkSession, root: str, run_date: str, types: T.StructType | None = None
) -> DataFrame:
    """One date of a zone.  Only that directory is listed, however many dates there are.

    Directory names carry no types, so Spark guesses those of partition columns.  ``types`` gives
    them: columns it names are read as it says where they are directories.
    """
    reader, path = spark.read.option("basePath", root), f"{root}/dt={run_date}"
    found = reader.parquet(path)
    if types is None:
        return found
    folders = _folder_columns(spark, path)
    given = {f.name: f.dataType for f in types if f.name in folders}
    schema = T.StructType([T.StructField(f.name, given.get(f.name, f.dataType), True, f.metadata) for f in found.schema])
    return reader.schema(schema).parquet(path)


def read_zone(
    spark: SparkSession, root: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """All dates of a zone; filter on ``dt`` to read few.

    ``merge_schema`` looks into every file for columns that came later; giving ``schema`` avoids
    that.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)


def _children(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below a directory, or None when it does not exist."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    return [status.getPath().getName() for status in files.listStatus(folder)]


def _folder_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns below a directory, from the names of its folders."""
    columns: list[str] = []
    while folders := [n for n in _children(spark, path) or [] if "=" in n and n[0] not in "._"]:
        columns.append(folders[0].partition("=")[0])
        path = f"{path}/{folders[0]}"
    return columns


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path (not a pattern) is a directory."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    return _children(spark, path) is not None


def dates(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a date partition column, in order.  Looks at directory names only."""
    prefix = f"{column}="
    return sorted(n.removeprefix(prefix) for n in _children(spark, root) or [] if n.startswith(prefix))


def latest_date(
    spark: SparkSession, root: str, column: str, before: str | None = None, besides: Collection[str] = ()
) -> str | None:
    """Latest value of a date partition column, before a date and apart from some if given.  Looks
    at directory names only."""
    known = dates(spark, root, column)
    return max((d for d in known if (before is None or d < before) and d not in besides), default=None)
