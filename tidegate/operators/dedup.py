"""Keep one row per hash or per key.

Both are ``row_number() = 1``: Spark cuts each task's rows down to the first of every group
before the shuffle, so a group of copies never travels or is sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def drop_repeated_rows(
    df: DataFrame, hash_column: str = "_row_md5", order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per hash, by default the one loaded first."""
    if order is None:
        order = [F.asc("_raw_load_ts"), F.asc("_pipeline_run_id")]
    return first_per_group(df, [hash_column], order)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should be total for repeatable results."""
    return first_per_group(df, keys, order)
