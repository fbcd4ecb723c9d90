"""Which features move with the label: correlations, ranking and wording."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _moments(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each pair of columns, over the rows of a task that have both: their number, the means, the
    squared deviations and the co-deviation.  Batches are merged by their differences in the mean."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = mean = spread = joint = np.zeros((size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            given = ~np.isnan(x)
            # Around a value of the column: exact for constants, and free of cancellation.
            around = np.array([c[g][0] if g.any() else 0.0 for c, g in zip(x.T, given.T, strict=True)])
            x = np.where(given, x - around, 0.0)
            mask = given.astype(float)
            here = mask.T @ mask
            some = np.maximum(here, 1)
            sums = x.T @ mask
            here_mean = around[:, None] + sums / some
            here_spread = (x**2).T @ mask - sums**2 / some
            here_joint = x.T @ x - sums * sums.T / some
            both = np.maximum(n + here, 1)
            apart, weight = here_mean - mean, n * here / both
            spread = spread + here_spread + apart**2 * weight
            joint = joint + here_joint + apart * apart.T * weight
            mean, n = np.where(n > 0, mean + apart * here / both, here_mean), n + here
        i, j = np.triu_indices(size)
        columns = [i, j, n[i, j], mean[i, j], mean[j, i], spread[i, j], spread[j, i], joint[i, j]]
        names = ["i", "j", "n", "mean_i", "mean_j", "spread_i", "spread_j", "joint"]
        kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return gather


def _correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i``, ``j`` and ``r`` for every pair of columns, from one pass; a task sends a row per pair.

    Pearson's correlation over the rows that have both values; NULL when either is constant there.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(columns)])
    schema = "i long, j long, n double, mean_i double, mean_j double, spread_i double, spread_j double, joint double"
    parts = numbers.mapInArrow(_moments(len(columns)), schema).where("n > 0")
    pair = Window.partitionBy("i", "j")
    # Means around the least one, so that equal means stay equal.
    above = parts.withColumns({f"mean_{s}": F.col(f"mean_{s}") - F.min(f"mean_{s}").over(pair) for s in "ij"})
    centred = above.withColumns(
        {f"mean_{s}": F.col(f"mean_{s}") - F.sum(F.col("n") * F.col(f"mean_{s}")).over(pair) / F.sum("n").over(pair) for s in "ij"}
    )
    n, x, y = F.col("n"), F.col("mean_i"), F.col("mean_j")
    merged = centred.groupBy("i", "j").agg(
        F.sum(F.col("spread_i") + n * x * x).alias("spread_i"),
        F.sum(F.col("spread_j") + n * y * y).alias("spread_j"),
        F.sum(F.col("joint") + n * x * y).alias("joint"),
    )
    return merged.select("i", "j", F.try_divide("joint", F.sqrt("spread_i") * F.sqrt("spread_j")).alias("r"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature_a, feature_b, correlation)`` for every ordered pair, from one pass."""
    names = F.array(*[F.lit(c) for c in columns])
    found = _correlations(df, columns).select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "r")
    cell = [F.struct(F.col(x).alias("feature_a"), F.col(y).alias("feature_b"), F.col("r").alias("correlation")) for x, y in ("ab", "ba")]
    return found.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(cell[0])).otherwise(F.array(*cell))))


def label_correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Correlation of each feature (and of the label itself) with the label, strongest first."""
    cells = correlation_matrix(df, [*features, label]).where(F.col("feature_b") == label)
    return cells.select(F.col("feature_a").alias("feature"), "correlation").orderBy(F.desc_nulls_last("correlation"), "feature")


def risk_drivers(correlations: DataFrame, label: str, top: int = 3) -> DataFrame:
    """The ``top`` features that go with the label most (``risk``) and least (``protective``).

    With few features a feature can be on both lists.
    """
    ranked = correlations.where((F.col("feature") != label) & F.col("correlation").isNotNull())

    def side(name: str, order: Column) -> DataFrame:
        return ranked.orderBy(order, "feature").limit(top).select(F.lit(name).alias("driver"), "*")

    return side("risk", F.desc("correlation")).unionByName(side("protective", F.asc("correlation")))


def narrate(drivers: DataFrame) -> DataFrame:
    """One sentence per risk driver."""
    value = F.col("correlation")
    direction = F.when(value >= 0, "increases").otherwise("decreases")
    sentence = F.concat(
        F.lit("Higher "), F.col("feature"), F.lit(" "), direction,
        F.lit(" default risk (correlation "), F.round(value, 2).cast("string"), F.lit(")"),
    )
    return drivers.where(F.col("driver") == "risk").select("feature", sentence.alias("narration"))
