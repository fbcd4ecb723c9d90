"""Logistic default model: stable split, fit, quality, scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.hashing import hash_bucket
from tidegate.functions.scoring import LOWEST_TIER, decision, logistic, risk_score, risk_tier
from tidegate.operators.risk import LABEL, MODEL_FEATURES

SPLIT_SEED = 42
TEST_BUCKETS = 2
#: The fit ends with the step whose expected gain, against the loss, is below this.
TOLERANCE = 1e-11
#: A step is halved at most so often before the fit gives up.
HALVINGS = 30
#: Above any probability: where rows without one rank.
_UNKNOWN_RANK = 2.0


def with_split(df: DataFrame, key: str = "loan_id", seed: int = SPLIT_SEED) -> DataFrame:
    """Mark about 20 % of the rows as test rows by a hash of the key: no shuffle, and the same
    rows on every run."""
    test = hash_bucket(F.col(key), seed) < TEST_BUCKETS
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


@dataclass(frozen=True)
class LoanModel:
    features: list[str]
    weights: list[float]
    intercept: float
    handle_invalid: str = "error"

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, self.weights, strict=True))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``default_probability`` and ``prediction`` (threshold one half): plain columns, NULL where
        a row is kept that lacks a feature."""
        given = _given(df, self.features, self.handle_invalid)
        probability = F.nanvl(logistic(self.coefficients, self.intercept), F.lit(None).cast("double"))
        scored = given.withColumn("default_probability", probability)
        return scored.withColumn("prediction", (F.col("default_probability") > 0.5).cast("double"))


def _given(df: DataFrame, features: Sequence[str], handle_invalid: str) -> DataFrame:
    """Rows whose features are all there: others are left out (``skip``), stay (``keep``) or fail the
    job (``error``)."""
    if handle_invalid == "keep":
        return df
    if handle_invalid == "skip":
        return df.dropna(subset=list(features))
    if handle_invalid != "error":
        raise ValueError(f"handle_invalid is 'error', 'skip' or 'keep', not {handle_invalid!r}")
    lacking = F.lit(None).cast("string")
    for f in features:
        value = F.col(f).cast("double")
        lacking = F.when(value.isNull() | F.isnan(value), F.lit(f"feature {f} is null")).otherwise(lacking)
    return df.where(F.when(lacking.isNull(), True).otherwise(F.raise_error(lacking).cast("boolean")))


def incomplete_rows(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """One row: how many rows lack at least one feature."""
    missing = F.lit(False)
    for f in features:
        missing = missing | F.col(f).isNull()
    return df.agg(F.count_if(missing).alias("incomplete_rows"), F.count("*").alias("rows"))


@dataclass(frozen=True)
class _Point:
    """The penalised loss, its gradient and its Hessian at some weights (the intercept first)."""

    weights: np.ndarray
    rows: int
    loss: float
    gradient: np.ndarray
    hessian: np.ndarray

    def step(self) -> tuple[np.ndarray, float]:
        """The Newton step and the gain it promises; scaled, because features differ in size by far."""
        scale = 1 / np.sqrt(np.maximum(np.diag(self.hessian), np.finfo(float).tiny))
        scaled = self.hessian * scale[:, None] * scale
        step = scale * np.linalg.lstsq(scaled, scale * self.gradient, rcond=None)[0]
        return step, float(step @ self.gradient)


def _point(rows: DataFrame, features: Sequence[str], label: str, weights: np.ndarray) -> _Point:
    """One pass over the rows: each task sums up its rows as matrices, the sums of all tasks come back."""
    size = len(features) + 1
    upper = np.triu_indices(size)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + size + len(upper[0]))
        for batch in batches:
            *given, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            x = np.column_stack([np.ones(len(y)), *given])
            z = x @ weights
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-z))
            # log(1 + exp(z)) - y z, without overflow
            loss = np.maximum(z, 0) - y * z + np.log1p(np.exp(-np.abs(z)))
            curved = x.T @ (x * (p * (1 - p))[:, None])
            total += np.concatenate(([len(y), loss.sum()], x.T @ (p - y), curved[upper]))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], names=["place", "part"])

    numbers = rows.select(*[F.col(c).cast("double") for c in (*features, label)])
    sums = numbers.mapInArrow(summed, "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    total = np.zeros(2 + size + len(upper[0]))
    for place, part in sums.collect():
        total[place] = part
    if not total[0]:
        raise ValueError("no complete training rows")
    penalty = np.r_[0.0, np.ones(size - 1)]
    hessian = np.zeros((size, size))
    hessian[upper] = total[2 + size :]
    hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
    gradient = total[2 : 2 + size] + penalty * weights
    return _Point(weights, int(total[0]), total[1] + penalty @ weights**2 / 2, gradient, hessian)


def fit(
    train: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = LABEL,
    max_iter: int = 100,
    handle_invalid: str = "error",
) -> LoanModel:
    """L2-regularised logistic regression with unit inverse strength and a free intercept.

    Newton's method: each pass over the rows sums up the loss, its gradient and its Hessian, some
    dozens of numbers whatever the number of rows; a step that would raise the loss is halved.  The
    loss is strictly convex in the coefficients, so the result does not depend on the way.  The rows
    are read once per pass, about ten times: pass a written table when they are expensive to
    compute.  Nothing is kept on executors.

    Rows that lack a feature fail the fit (``error``) or take no part in it (``skip``, ``keep``); the
    model treats the rows it predicts in the same way, but that ``keep`` keeps them, without a probability.
    """
    rows = _given(train, features, "skip" if handle_invalid == "keep" else handle_invalid)
    here = _point(rows, features, label, np.zeros(len(features) + 1))
    for _ in range(max_iter):
        step, gain = here.step()
        if gain <= TOLERANCE * here.loss:
            end = here.weights - step
            return LoanModel(list(features), [float(w) for w in end[1:]], float(end[0]), handle_invalid)
        for _ in range(HALVINGS):
            there = _point(rows, features, label, here.weights - step)
            if there.loss <= here.loss:
                break
            step = step / 2
        else:
            raise ArithmeticError("no step lowers the loss")
        here = there
    raise ArithmeticError(f"not at the optimum after {max_iter} steps")


def prediction_quality(predicted: DataFrame, label: str = LABEL) -> tuple[float | None, float | None]:
    """(accuracy, area under the ROC curve with ties counted half).

    A row without a probability is not predicted rightly, and ranks above all others as the worst risk.
    Undefined values are those of SQL: both None without rows, the area None where no label is 1 and NaN
    where none is 0.  The rows are read several times: pass a written table when they are expensive to compute.
    """
    right = F.coalesce(F.col("prediction") == F.col(label), F.lit(False))
    labels = [F.count_if(F.col(label) == y).alias(f"n{y}") for y in (0, 1)]
    accuracy, negative, positive = predicted.agg(F.avg(right.cast("double")).alias("a"), *labels).first()
    if not positive:
        return accuracy, None
    if not negative:
        return accuracy, float("nan")
    ranked = F.coalesce(F.col("default_probability"), F.lit(_UNKNOWN_RANK))
    area = BinaryClassificationEvaluator(
        rawPredictionCol="default_probability", labelCol=label, metricName="areaUnderROC", numBins=0
    ).evaluate(predicted.withColumn("default_probability", ranked))
    return accuracy, float(area)


def with_decision(df: DataFrame, reject_unscored: bool = False) -> DataFrame:
    """Score, tier and decision from ``default_probability``.  A row without one has no tier and no
    decision, or with ``reject_unscored`` the lowest."""
    tier = risk_tier(F.col("risk_score"))
    if reject_unscored:
        tier = F.coalesce(tier, F.lit(LOWEST_TIER[0]))
    return (
        df.withColumn("risk_score", risk_score(F.col("default_probability")))
        .withColumn("risk_tier", tier)
        .withColumn("decision", decision(F.col("risk_tier")))
    )
