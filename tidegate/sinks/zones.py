"""Writing the zones.  A run owns one date of each dataset and always overwrites it, also with
nothing, so a rerun leaves no rows of the run before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import Contract
from tidegate.sources.zones import dates


@dataclass(frozen=True)
class Zones:
    """Directories of one dataset below a base path, each a clean ``dt``-partitioned dataset."""

    base: str
    dataset: str

    def _root(self, zone: str) -> str:
        return f"{self.base.rstrip('/')}/{self.dataset}/{zone}"

    @property
    def valid(self) -> str:
        return self._root("valid")

    @property
    def quarantine(self) -> str:
        return self._root("quarantine")

    @property
    def summary(self) -> str:
        return self._root("quarantine_summary")

    @property
    def audit(self) -> str:
        return self._root("audit")

    @property
    def current(self) -> str:
        return self._root("staging_current")

    @property
    def history(self) -> str:
        return self._root("staging_history")


def write_date(df: DataFrame, root: str, run_date: str, partition_columns: Sequence[str] = ()) -> None:
    """Overwrite one date with Parquet, optionally split further by columns."""
    df.write.mode("overwrite").partitionBy(*partition_columns).parquet(f"{root}/dt={run_date}")


def write_records(df: DataFrame, root: str, run_date: str) -> None:
    """Overwrite one date with JSON records (summaries and audit rows)."""
    df.write.mode("overwrite").json(f"{root}/dt={run_date}")


def clear_date(spark: SparkSession, root: str, run_date: str) -> None:
    """Remove one date of a dataset, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/dt={run_date}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder) and not files.delete(folder, True):
        raise OSError(f"cannot remove {root}/dt={run_date}")


def write_csv(df: DataFrame, path: str) -> None:
    """A headered CSV dataset, for consumers that want text."""
    df.write.mode("overwrite").option("header", True).csv(path)


def declare_table(
    spark: SparkSession, table: str, root: str, schema: T.StructType, partition_column: str = "dt"
) -> None:
    """Make a zone queryable by name, with the partitions it has now."""
    columns = [f for f in schema.fields if f.name != partition_column]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}, `{partition_column}` DATE) "
        f"USING parquet PARTITIONED BY (`{partition_column}`) LOCATION '{root}'"
    )
    if partition_column == "dt":
        spark.sql(f"MSCK REPAIR TABLE {table}")
    else:
        # Folders are named after dt; under another name each date is told its place.
        for run_date in dates(spark, root, "dt"):
            add_table_date(spark, table, root, run_date, partition_column)


def declare_contract_table(spark: SparkSession, contract: Contract, zones: Zones, schema: T.StructType) -> str:
    """The valid zone under the database and table that the contract names; returns the full name.

    The table's partition column is the contract's, whatever the zone's folders are called; a column
    that the rows have themselves is refused.
    """
    column = contract.partition_column.lstrip("_")
    if column != "dt" and column in schema.fieldNames():
        raise ValueError(f"{column} is a column of the rows, so it cannot be the date of the table")
    name = f"`{contract.table or contract.name}`"
    if contract.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{contract.database}`")
        name = f"`{contract.database}`.{name}"
    declare_table(spark, name, zones.valid, schema, column)
    return name


def add_table_date(spark: SparkSession, table: str, root: str, run_date: str, partition_column: str = "dt") -> None:
    """Register one date of a declared table without listing the others."""
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (`{partition_column}` = DATE '{run_date}') "
        f"LOCATION '{root}/dt={run_date}'"
    )


def manifest_records(facts: DataFrame, version: str, run_date: str) -> DataFrame:
    """File facts as manifest records."""
    return facts.select(
        F.regexp_replace("file_name", "(_[0-9]{8})?[.]csv$", "").alias("dataset_name"),
        F.lit(version).alias("version"),
        F.col("file_name").alias("filename"),
        F.lit(run_date).alias("run_date"),
        F.lit("MD5").alias("checksum_algo"),
        "checksum",
        F.col("data_rows").alias("expected_rows"),
        "file_size_bytes",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
    )


def write_manifests(facts: DataFrame, path: str, version: str, run_date: str) -> None:
    """One JSON record per delivered file."""
    manifest_records(facts, version, run_date).write.mode("overwrite").json(path)
