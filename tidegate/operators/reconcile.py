"""Compare two layers by row counts per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_counts(raw: DataFrame, staging: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows per group on both sides, their difference and MATCH/MISMATCH.

    Both sides are aggregated before they meet, so the join sees one row per group; NULL is a
    group like any other.
    """
    left = raw.groupBy(*groups).agg(F.count("*").alias("raw_rows"))
    right = staging.groupBy(*[F.col(g).alias(f"_s_{g}") for g in groups]).agg(
        F.count("*").alias("staging_rows")
    )
    on = None
    for g in groups:
        same = F.col(g).eqNullSafe(F.col(f"_s_{g}"))
        on = same if on is None else on & same
    counts = left.join(right, on, "full_outer")
    on_left = F.col("raw_rows").isNotNull()
    raw_rows = F.coalesce("raw_rows", F.lit(0))
    staging_rows = F.coalesce("staging_rows", F.lit(0))
    return counts.select(
        *[F.when(on_left, F.col(g)).otherwise(F.col(f"_s_{g}")).alias(g) for g in groups],
        raw_rows.alias("raw_rows"),
        staging_rows.alias("staging_rows"),
        (raw_rows - staging_rows).alias("diff"),
        F.when(raw_rows == staging_rows, "MATCH").otherwise("MISMATCH").alias("status"),
    )
