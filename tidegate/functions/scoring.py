"""Risk scoring expressions: probability -> score -> tier -> decision."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score scale, tier floors, tier names and decisions.
SCORE_SPAN = 600
SCORE_BASE = 300
TIERS = [
    (750, "A - Low Risk", "Approve"),
    (650, "B - Medium Risk", "Approve with conditions"),
    (550, "C - High Risk", "Manual review"),
]
LOWEST_TIER = ("D - Very High Risk", "Reject")

LATE_DAYS = 0
MISSED_DAYS = 30
DEFAULT_DAYS = 90


def default_flag(max_days_past_due: Column) -> Column:
    """1 from 90 days past due on; no repayment history counts as 0."""
    return F.coalesce(max_days_past_due >= DEFAULT_DAYS, F.lit(False)).cast("int")


def logistic(weights: Mapping[str, float], intercept: float) -> Column:
    """Default probability from given coefficients, as a plain projection."""
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.lit(float(weight)) * F.col(name)
    return 1.0 / (1.0 + F.exp(-z))


def risk_score(probability: Column) -> Column:
    """300 … 900, higher is safer; fractions are cut, not rounded."""
    return ((1 - probability) * SCORE_SPAN + SCORE_BASE).cast("int")


def risk_tier(score: Column) -> Column:
    tier = F.when(score >= TIERS[0][0], TIERS[0][1])
    for floor, name, _ in TIERS[1:]:
        tier = tier.when(score >= floor, name)
    return tier.when(score.isNotNull(), LOWEST_TIER[0])


def decision(tier: Column) -> Column:
    choice = F.when(tier == TIERS[0][1], TIERS[0][2])
    for _, name, outcome in TIERS[1:]:
        choice = choice.when(tier == name, outcome)
    return choice.when(tier.isNotNull(), LOWEST_TIER[1])
