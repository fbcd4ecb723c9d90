"""The loan job: features, model, scores, decisions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.model import LoanModel, fit, prediction_quality, with_decision, with_split
from tidegate.operators.risk import MODEL_FEATURES


@dataclass(frozen=True)
class Assessment:
    model: LoanModel
    accuracy: float | None
    area_under_roc: float | None
    scored: DataFrame


def assess(
    features: DataFrame, columns: Sequence[str] = MODEL_FEATURES, handle_invalid: str = "error"
) -> Assessment:
    """Fit on the training rows, judge on the test rows, decide on all rows.

    ``features`` is read several times; pass a written table or a persisted frame when it is
    expensive to compute.  With ``handle_invalid="keep"`` loans that lack a feature are rejected.
    """
    marked = with_split(features)
    model = fit(marked.where(F.col("split") == "train"), columns, handle_invalid=handle_invalid)
    scored = model.predict(marked)
    accuracy, area = prediction_quality(scored.where(F.col("split") == "test"))
    return Assessment(model, accuracy, area, with_decision(scored, reject_unscored=handle_invalid == "keep"))
