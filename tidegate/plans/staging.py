"""Raw to staging: one deduplicated snapshot merged into the versions kept so far.

Open versions and closed history are two datasets.  A run reads the open versions of the run
before it and writes its own: ``staging_current/as_of=<date>`` and, for what it closed,
``staging_history/effective_to=<date>``.  History is never rewritten, no run overwrites what it
reads, and running a date again replaces exactly what that date wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidegate.contract import Contract
from tidegate.operators.dedup import latest_per_key
from tidegate.operators.enforce import cleanse
from tidegate.operators.reconcile import reconcile_counts
from tidegate.operators.scd2 import merge_current, open_versions
from tidegate.sinks.zones import Zones
from tidegate.sources.zones import exists, latest_date, read_partition


def snapshot_of(raw: DataFrame, contract: Contract, keys: Sequence[str]) -> DataFrame:
    """Raw rows of one date as a snapshot: one row per key, declared cleansing applied, contract
    columns only.

    Repeated deliveries of a row share its key, so choosing per key removes them as well and a
    separate pass by row hash would only add a shuffle.  When a key comes twice with different
    content, the row loaded last wins, then the larger hash: the same choice on every run.
    """
    order = [F.desc("_raw_load_ts"), F.desc("_row_md5")]
    return cleanse(latest_per_key(raw, keys, order).select(*contract.names), contract)


def run_staging(
    spark: SparkSession,
    contract: Contract,
    zones: Zones,
    run_date: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    close_missing: bool = False,
) -> None:
    """Merge the raw rows of ``run_date`` into staging.

    Only for dates whose ingest did not fail: with ``close_missing`` an empty raw date closes
    every version.
    """
    date.fromisoformat(run_date)
    snapshot = snapshot_of(read_partition(spark, zones.valid, run_date, contract.struct()), contract, keys)
    previous = latest_date(spark, zones.current, "as_of", before=run_date)
    if previous is None:
        versions = open_versions(snapshot, tracked, run_date)
    else:
        current = spark.read.parquet(f"{zones.current}/as_of={previous}")
        versions = merge_current(current, snapshot, keys, tracked, run_date, close_missing, one_per_key=True)
    versions = versions.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        versions.where("is_current").write.mode("overwrite").parquet(f"{zones.current}/as_of={run_date}")
        closed = versions.where("NOT is_current").drop("effective_to")
        closed.write.mode("overwrite").parquet(f"{zones.history}/effective_to={run_date}")
    finally:
        versions.unpersist()


def read_current(spark: SparkSession, zones: Zones, run_date: str) -> DataFrame:
    """Open versions as a run of that date left them."""
    return spark.read.parquet(f"{zones.current}/as_of={run_date}")


def read_dimension(spark: SparkSession, zones: Zones, run_date: str) -> DataFrame:
    """All versions known on ``run_date``, open and closed, with the columns of that date."""
    current = read_current(spark, zones, run_date)
    if not exists(spark, zones.history):
        return current
    closed = spark.read.schema(current.schema).parquet(zones.history).where(F.col("effective_to") <= F.lit(run_date).cast("date"))
    return current.unionByName(closed.select(*current.columns))


def reconcile(
    spark: SparkSession, contract: Contract, zones: Zones, run_date: str, groups: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Raw snapshot against open versions, rows per group."""
    raw = snapshot_of(read_partition(spark, zones.valid, run_date, contract.struct()), contract, keys)
    return reconcile_counts(raw, read_current(spark, zones, run_date), groups)
