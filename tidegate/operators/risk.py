"""Loan risk features: repayment history per loan, joined with the loan and its borrower."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scoring import LATE_DAYS, MISSED_DAYS, default_flag
from tidegate.operators.skew import HOT_ROWS, salted_join

# The columns the default model is trained on, and those compared with the label.
MODEL_FEATURES = [
    "late_payment_ratio", "missed_payment_count", "emi_income_ratio", "income", "credit_score",
    "loan_amount", "tenure",
]
DRIVER_FEATURES = [
    "late_payment_ratio", "missed_payment_count", "emi_income_ratio", "income", "credit_score",
]
LABEL = "default_flag"


def repayment_features(repayments: DataFrame) -> DataFrame:
    """One row per loan: mean and worst days past due, late and missed counts, late ratio.

    All aggregates combine on the map side, so a loan with very many repayments costs each task
    one partial row.
    """
    days = F.col("days_past_due")
    return (
        repayments.where(F.col("loan_id").isNotNull())
        .groupBy("loan_id")
        .agg(
            F.avg(days).alias("avg_days_past_due"),
            F.max(days).alias("max_days_past_due"),
            F.count_if(days > LATE_DAYS).alias("late_payment_count"),
            F.count_if(days >= MISSED_DAYS).alias("missed_payment_count"),
            F.count("emi_number").alias("total_payments"),
        )
        .withColumn("late_payment_ratio", F.try_divide("late_payment_count", "total_payments"))
    )


def _suffix_overlap(left: DataFrame, right: DataFrame, keys: set[str]) -> tuple[DataFrame, DataFrame]:
    """Columns that both sides have, apart from the keys, become ``_x`` (left) and ``_y``."""
    both = (set(left.columns) & set(right.columns)) - keys
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in both}),
        right.withColumnsRenamed({c: f"{c}_y" for c in both}),
    )


def loan_features(
    repayments: DataFrame, loans: DataFrame, borrowers: DataFrame, min_hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Labelled feature row per loan that has repayments.

    Borrowers are attached to loans first: that join starts from the loan scan (pass ``loans``
    as scanned, narrow steps only), so the rows of a borrower with very many loans can be spread,
    and it moves the few loan columns only.  The aggregate and the join that follows share one
    partitioning by ``loan_id``.  Unknown borrowers
    leave NULLs; a missing borrower id matches a missing borrower id.
    """
    history = repayment_features(repayments)
    history, loans = _suffix_overlap(history, loans, {"loan_id"})
    loans, borrowers = _suffix_overlap(loans, borrowers, {"borrower_id"})
    with_borrower = salted_join(
        loans, borrowers, ["borrower_id"], "left", null_safe=True, min_rows=min_hot_rows
    )
    return (
        history.join(with_borrower, "loan_id", "inner")
        .withColumn("emi_income_ratio", F.try_divide("emi_amount", "income"))
        .withColumn(LABEL, default_flag(F.col("max_days_past_due")))
    )


def feature_matrix(features: DataFrame) -> DataFrame:
    """The model's input columns, with the loan and the label."""
    return features.select("loan_id", *MODEL_FEATURES, LABEL)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), column)
    )


def default_rate(features: DataFrame) -> DataFrame:
    return features.agg(F.avg(LABEL).alias("default_rate"))


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
