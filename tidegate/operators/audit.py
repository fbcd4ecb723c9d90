"""Run context on rows (audit columns, hash) and counts about rows (batch metrics)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.hashing import content_columns, row_hash
from tidegate.operators.enforce import SCHEMA_LAYER
from tidegate.operators.quality import DQ_LAYER


def add_row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``_row_md5`` over ``columns``, by default over all content columns."""
    chosen = list(columns) if columns is not None else content_columns(df.columns)
    return df.withColumn("_row_md5", row_hash(chosen))


def add_audit_columns(
    df: DataFrame, dataset: str, run_date: str, run_id: str, hash_columns: Iterable[str] | None = None
) -> DataFrame:
    """Load time, run id, dataset, date and row hash of rows entering the raw zone."""
    chosen = list(hash_columns) if hash_columns is not None else content_columns(df.columns)
    return df.select(
        "*",
        F.current_timestamp().alias("_raw_load_ts"),
        F.lit(run_id).alias("_pipeline_run_id"),
        F.lit(dataset).alias("_source_dataset"),
        F.lit(run_date).alias("_dt"),
        row_hash(chosen).alias("_row_md5"),
    )


def add_quarantine_columns(df: DataFrame, run_id: str) -> DataFrame:
    return df.select("*", F.current_timestamp().alias("quarantine_ts"), F.lit(run_id).alias("pipeline_run_id"))


def batch_metrics() -> list[Column]:
    """Counts over annotated rows; read = schema_rejected + dq_failed + valid."""
    layer = F.col("rejection_layer")
    return [
        F.count("*").alias("read"),
        F.count_if(layer == SCHEMA_LAYER).alias("schema_rejected"),
        F.count_if(layer == DQ_LAYER).alias("dq_failed"),
        F.count_if(layer.isNull()).alias("valid"),
        F.count_if(layer.isNull() & (F.col("dq_status") == "WARN")).alias("warned"),
    ]


def split_metrics() -> tuple[dict[str, Column], dict[str, Column]]:
    """The same counts, apart: those over valid rows, and those over refused ones."""
    layer = F.col("rejection_layer")
    valid = {"valid": F.count(F.lit(1)), "warned": F.count_if(F.col("dq_status") == "WARN")}
    refused = {"schema_rejected": F.count_if(layer == SCHEMA_LAYER), "dq_failed": F.count_if(layer == DQ_LAYER)}
    return valid, refused


def reason_counts(rejected: DataFrame, *context: str) -> DataFrame:
    """Rows per rejection layer and reason, and per column of the context."""
    return rejected.groupBy(*context, "rejection_layer", "rejection_reason").agg(F.count("*").alias("rows"))
