"""Typed scans of the loan CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPAYMENTS = "loan_id STRING, emi_number INT, days_past_due DOUBLE"
LOANS = "loan_id STRING, borrower_id STRING, loan_amount DOUBLE, tenure INT, emi_amount DOUBLE"
BORROWERS = "borrower_id STRING, income DOUBLE, credit_score INT"

# Texts a CSV cell may hold when the value is missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` found by header name; missing and unusable texts become NULL.

    Reading only what the schema names lets Spark prune the other columns of the file.  Files of
    one folder must share their header; one that differs fails the scan.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)

    def typed(f: T.StructField):
        raw = F.col(f"`{f.name}`")
        value = F.when(~raw.isin(MISSING_TEXTS), raw)
        if isinstance(f.dataType, T.StringType):
            return value.alias(f.name)
        number = value.try_cast("double")
        if isinstance(f.dataType, T.DoubleType):
            return F.when(~F.isnan(number), number).alias(f.name)
        exact = number == F.floor(number)
        return F.coalesce(value.try_cast(f.dataType), F.when(exact, number).try_cast(f.dataType)).alias(f.name)

    return text.select(*[typed(f) for f in T.StructType.fromDDL(schema).fields])


def read_repayments(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, REPAYMENTS)


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, LOANS)


def read_borrowers(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, BORROWERS)
