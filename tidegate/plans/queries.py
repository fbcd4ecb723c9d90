"""Every operator as a query over the driver's tables.

The tables hold clean data, so dirt is derived from their keys; ``oracles`` states the same
derivations and expectations in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.catalog import EMPLOYEE_MASTER, PAYROLL_TRANSACTIONS
from tidegate.contract import HARD, SOFT, Contract, Rule
from tidegate.functions import checks as C
from tidegate.functions.scoring import logistic
from tidegate.functions.text import remove_dashes_and_spaces, strip_non_numeric_except_plus
from tidegate.operators import audit, dedup, drivers, enforce, evolution, quality, reconcile, risk, scd2
from tidegate.operators.manifests import verify_files
from tidegate.operators.model import (
    fit,
    incomplete_rows,
    prediction_quality,
    with_decision,
    with_split,
)
from tidegate.plans import ingest, staging
from tidegate.plans.risk import assess
from tidegate.plans.workspace import new_folder
from tidegate.sinks.zones import (
    Zones,
    add_table_date,
    declare_contract_table,
    declare_table,
    manifest_records,
    write_csv,
    write_date,
)
from tidegate.sources.files import file_facts, read_manifest_records, read_manifests
from tidegate.sources.landing import list_files, read_landing
from tidegate.sources.loans import read_borrowers, read_loans, read_repayments
from tidegate.sources.synthetic import employees, payroll
from tidegate.sources.zones import exists, read_partition, read_zone
from tidegate.streaming.arrivals import pair_arrivals, read_verdicts, start_verification, stream_files, stream_manifests
from tidegate.streaming.landing import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- delivered frames ------------------------------------------------------------------------

CUSTOMER = Contract.define(
    "customer",
    mandatory="c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    optional="c_acctbal DOUBLE, joined DATE",
    details={"joined": {"format": "yyyy-MM-dd"}},
    rules=[
        C.not_null("c_name"),
        C.regex_match("c_name", "^Customer#[0-9]{8}[0-8]$", HARD),
        C.allowed_values("c_mktsegment", ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
        C.positive_number("c_acctbal"),
        Rule("joined", "date_format", SOFT, {"format": "yyyy-MM-dd"}),
    ],
)
CUSTOMER_RULES = [
    C.allowed_values("c_mktsegment", ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
    C.regex_match("c_name", "^Customer#[0-9]{8}[0-8]$", HARD),
    C.positive_number("c_acctbal"),
]


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def delivered_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as text, with null tokens, bad numbers and bad dates at fixed keys."""
    k = F.col("c_custkey")
    segment = (
        F.when(_every(k, 11), "NA").when(_every(k, 13), "  ").when(_every(k, 17), "none").otherwise(F.col("c_mktsegment"))
    )
    balance = F.when(_every(k, 19), "12abc").when(_every(k, 23), "").otherwise(F.col("c_acctbal").cast("string"))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int"))
    joined = (
        F.when(_every(k, 29), "2024-13-01")
        .when(_every(k, 31), "2024-1-5")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return _table(spark, sf, "customer").select(
        k.cast("string").alias("c_custkey"),
        "c_name",
        segment.alias("c_mktsegment"),
        balance.alias("c_acctbal"),
        joined.alias("joined"),
    )


def annotated_customers(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.annotate(delivered_customers(spark, sf), CUSTOMER)


# -- contract enforcement ----------------------------------------------------------------------


@query
def enforce_customer(spark: SparkSession, sf: str) -> DataFrame:
    return enforce.enforce(delivered_customers(spark, sf), CUSTOMER).drop("raw_record")


ORDERS = Contract.define(
    "orders",
    mandatory="o_orderkey BIGINT, o_placed TIMESTAMP",
    optional="o_custkey INT, o_urgent BOOLEAN, o_day DATE, o_totalprice DOUBLE",
)


def delivered_orders(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    placed = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    flag = F.element_at(
        F.array(*[F.lit(v) for v in ("true", "F", "yes", "0", "maybe", "n/a")]), (k % 6 + 1).cast("int")
    )
    return _table(spark, sf, "orders").select(
        F.when(_every(k, 41), "1.5").otherwise(k.cast("string")).alias("o_orderkey"),
        F.when(_every(k, 37), F.substring(placed, 1, 10)).when(_every(k, 43), " NULL ").otherwise(placed).alias("o_placed"),
        F.when(_every(k, 47), "99999999999").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        flag.alias("o_urgent"),
        F.when(_every(k, 53), "2024-02-30").otherwise(F.substring(placed, 1, 10)).alias("o_day"),
        F.when(_every(k, 59), "N/a").otherwise((k % 1000).cast("string")).alias("o_totalprice"),
    )


@query
def enforce_orders(spark: SparkSession, sf: str) -> DataFrame:
    typed = enforce.enforce(delivered_orders(spark, sf), ORDERS).drop("raw_record")
    return typed.withColumn("o_placed", F.date_format("o_placed", "yyyy-MM-dd HH:mm:ss"))


@query
def enforce_additive(spark: SparkSession, sf: str) -> DataFrame:
    """An optional column is missing, an unknown one has been added."""
    k = F.col("c_custkey").cast("bigint")
    extra = F.when(_every(k, 7), " N/A ").otherwise(F.concat(F.lit(" x"), F.col("c_custkey")))
    frame = delivered_customers(spark, sf).withColumn("loyalty", extra).drop("joined")
    return enforce.enforce(frame, CUSTOMER).drop("raw_record")


@query
def enforce_refused(spark: SparkSession, sf: str) -> DataFrame:
    """A mandatory column is missing: the whole batch is refused, with its texts."""
    frame = delivered_customers(spark, sf).drop("c_name")
    return enforce.enforce(frame, CUSTOMER).select("c_custkey", "rejection_reason", "raw_record")


@query
def enforce_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rejected = enforce.schema_rejected(enforce.enforce(delivered_customers(spark, sf), CUSTOMER))
    return audit.reason_counts(rejected)


@query
def reject_records(spark: SparkSession, sf: str) -> DataFrame:
    """What was delivered, for every row that was refused in either layer."""
    return ingest.refused_rows(annotated_customers(spark, sf)).select(
        "rejection_layer", "rejection_reason", "raw_record"
    )


# -- data quality --------------------------------------------------------------------------------


def checked_customers(spark: SparkSession, sf: str) -> DataFrame:
    return quality.apply_checks(_table(spark, sf, "customer"), C.build_checks(CUSTOMER_RULES))


@query
def dq_customer(spark: SparkSession, sf: str) -> DataFrame:
    return checked_customers(spark, sf).select("c_custkey", *quality.DQ_COLUMNS)


@query
def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.status_profile(checked_customers(spark, sf), soft_fail_threshold=0.05)


@query
def dq_per_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failures_per_check(_table(spark, sf, "customer"), C.build_checks(CUSTOMER_RULES))


@query
def dq_split(spark: SparkSession, sf: str) -> DataFrame:
    failed = quality.dq_failed(checked_customers(spark, sf))
    return failed.select("c_custkey", "rejection_reason", "rejection_layer", "validation_flag")


@query
def dq_valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dq_valid(checked_customers(spark, sf)).drop("validation_flag")


LINEITEM_RULES = [
    C.regex_match("l_returnflag", "^[AN]$"),
    C.regex_match("l_returnflag", "[NR]"),
    C.not_null("l_linestatus"),
    C.allowed_values("l_linestatus", ["O"]),
    C.positive_number("net", HARD),
    C.date_range("l_shipdate", "1996-01-01", "2000-12-31"),
    C.column_ge("l_extendedprice", "floor_price"),
]


def _lineitem_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_orderkey")
    return _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.when(k % 97 != 0, F.col("l_linestatus")).alias("l_linestatus"),
        (F.col("l_quantity") - 5).alias("net"),
        F.when(k % 89 != 0, F.col("l_shipdate")).alias("l_shipdate"),
        "l_extendedprice",
        F.when(k % 83 != 0, F.col("l_quantity") * 1200).alias("floor_price"),
    )


@query
def dq_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Seven checks of both severities, two of them of one kind on one column."""
    checked = quality.apply_checks(_lineitem_with_gaps(spark, sf), C.build_checks(LINEITEM_RULES))
    return checked.groupBy(*quality.DQ_COLUMNS).agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("key_sum")
    )


@query
def dq_dates(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        C.date_not_future("o_orderdate", HARD),
        C.date_range("o_orderdate", "1994-01-01", "1997-12-31"),
    ]
    orders = _table(spark, sf, "orders")
    checked = quality.apply_checks(orders, C.build_checks(rules, as_of="1999-06-30"))
    return checked.select("o_orderkey", *quality.DQ_COLUMNS)


@query
def dq_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Text length over whole documents, and one column against another."""
    documents = _table(spark, sf, "documents").withColumn("text_chars", F.length("text"))
    rules = [
        C.min_length("text", 300),
        C.column_ge("n_chars", "text_chars", HARD),
        C.allowed_values("lang", ["en", "fr"]),
    ]
    return quality.apply_checks(documents, C.build_checks(rules)).select("doc_id", *quality.DQ_COLUMNS)


@query
def dq_declared(spark: SparkSession, sf: str) -> DataFrame:
    """Constraints declared on columns become soft checks where no rule covers them."""
    contract = Contract.define(
        "customer",
        mandatory="c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
        details={
            "c_mktsegment": {"allowed_values": ["BUILDING", "MACHINERY"]},
            "c_name": {"regex": "[02468]$"},
        },
        rules=[C.allowed_values("c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"], HARD)],
    )
    checked = quality.apply_checks(_table(spark, sf, "customer"), C.build_checks(contract.declared_rules()))
    return checked.select("c_custkey", *quality.DQ_COLUMNS)


@query
def unique_key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated_keys(_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Key uniqueness as a row-level check, together with an ordinary one."""
    keys = ["l_orderkey", "l_linenumber"]
    flagged = quality.flag_duplicates(_table(spark, sf, "lineitem"), keys)
    checks = C.build_checks([C.allowed_values("l_returnflag", ["A", "N"])])
    checked = quality.apply_checks(flagged, [*checks, quality.unique_check(keys, severity=HARD)])
    return checked.groupBy(*quality.DQ_COLUMNS).agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("key_sum")
    )


def _some_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "customer").where(F.col("c_custkey") % 7 != 0)


@query
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers that are not in the parent table (which lacks every seventh)."""
    return quality.orphans(_table(spark, sf, "orders"), _some_customers(spark, sf), "o_custkey", "c_custkey")


def _hot(key: Column, row: Column) -> Column:
    """A key that a third of the rows share and a sixth lack."""
    return F.when(row % 3 == 0, 1).when(row % 6 == 1, None).otherwise(key)


#: Low enough for the hot keys of these queries at any scale.
HOT_FROM = 50


@query
def orphans_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans with a hot key, many missing keys, and an INT foreign key against a BIGINT parent."""
    k = F.col("o_orderkey")
    orders = _table(spark, sf, "orders").select("o_orderkey", _hot(F.col("o_custkey"), k).cast("int").alias("o_custkey"))
    return quality.orphans(orders, _some_customers(spark, sf), "o_custkey", "c_custkey", HOT_FROM)


@query
def unique_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Key uniqueness with a hot key and many missing keys."""
    k = F.col("l_orderkey")
    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", _hot(k, k).alias("k"))
    flagged = quality.flag_duplicates(lines, ["k", "l_linenumber"], min_rows=HOT_FROM)
    return flagged.groupBy("_is_repeated").agg(F.count("*").alias("rows"), F.sum("l_orderkey").alias("key_sum"))


@query
def features_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Loan features where a borrower has a third of the loans and many loans have none."""
    repayments, loans, borrowers = _loan_tables(spark, sf)
    loans = loans.withColumn("borrower_id", _hot(F.col("borrower_id"), F.col("loan_id")).cast("int"))
    features = risk.loan_features(repayments, loans, borrowers, HOT_FROM)
    return features.select("loan_id", "borrower_id", "income", "credit_score", "default_flag")


@query
def dq_exists(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders = _table(spark, sf, "orders").withColumn("o_custkey", F.when(k % 5 != 0, F.col("o_custkey")))
    flagged = quality.flag_orphans(orders, _some_customers(spark, sf), "o_custkey", "c_custkey")
    checked = quality.apply_checks(flagged, [quality.exists_check("o_custkey")])
    return checked.select("o_orderkey", *quality.DQ_COLUMNS)


@query
def quarantine_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Refused rows of both layers per reason."""
    return audit.reason_counts(ingest.refused_rows(annotated_customers(spark, sf)))


@query
def batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    return annotated_customers(spark, sf).agg(*audit.batch_metrics())


# -- audit columns and hashes ---------------------------------------------------------------------


@query
def row_hash_customer(spark: SparkSession, sf: str) -> DataFrame:
    return audit.add_row_hash(_table(spark, sf, "customer")).select("c_custkey", "_row_md5")


@query
def row_hash_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Default columns: run context beside the data does not change the hash."""
    rows = _table(spark, sf, "lineitem").withColumns({"_dt": F.lit("x"), "dq_status": F.lit("PASS")})
    return audit.add_row_hash(rows).select("l_orderkey", "l_linenumber", "_row_md5")


@query
def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows as they enter the raw zone (load time aside)."""
    valid = ingest.valid_rows(annotated_customers(spark, sf))
    return audit.add_audit_columns(valid, "customer", "2024-01-15", "run-1", ["c_custkey", "c_name"]).drop("_raw_load_ts")


@query
def dedup_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of the same rows: the earlier load is kept."""
    rows = audit.add_row_hash(_table(spark, sf, "lineitem"))
    first = rows.select("l_orderkey", "l_linenumber", "_row_md5", F.lit(1).alias("_raw_load_ts"), F.lit("a").alias("_pipeline_run_id"))
    again = first.withColumns({"_raw_load_ts": F.lit(2), "_pipeline_run_id": F.lit("b")})
    return dedup.drop_repeated_rows(again.unionByName(first))


@query
def cleanse(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("+91-"), F.col("c_name"), F.lit(" \t9-"))
    return _table(spark, sf, "customer").select(
        "c_custkey",
        remove_dashes_and_spaces(name).alias("compact"),
        strip_non_numeric_except_plus(name).alias("phone"),
    )


# -- layers ----------------------------------------------------------------------------------------

SCD2_TRACKED = ["c_mktsegment"]


def _day(spark: SparkSession, sf: str, without: int, changed: int) -> DataFrame:
    """A snapshot that lacks every ``without``-th key and has another segment at every
    ``changed``-th."""
    k = F.col("c_custkey")
    segment = F.when(k % changed == 0, "CHANGED").otherwise(F.col("c_mktsegment"))
    return _table(spark, sf, "customer").where(k % without != 0).select("c_custkey", "c_name", segment.alias("c_mktsegment"))


def _first_day(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.open_versions(_day(spark, sf, 10, 1_000_000_007), SCD2_TRACKED, "2024-01-01")


def _merge(dimension: DataFrame, snapshot: DataFrame, day: str) -> DataFrame:
    return scd2.merge(dimension, snapshot, ["c_custkey"], SCD2_TRACKED, day, close_missing=True)


@query
def scd2_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(_first_day(spark, sf), _day(spark, sf, 13, 7), "2024-01-02").drop("version_hash")


@query
def scd2_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Running a day again changes nothing."""
    snapshot = _day(spark, sf, 13, 7)
    once = _merge(_first_day(spark, sf), snapshot, "2024-01-02")
    return _merge(once, snapshot, "2024-01-02").drop("version_hash")


@query
def scd2_three_days(spark: SparkSession, sf: str) -> DataFrame:
    """Insert, change, change back, disappear, reappear."""
    two = _merge(_first_day(spark, sf), _day(spark, sf, 13, 7), "2024-01-02")
    return _merge(two, _day(spark, sf, 17, 1_000_000_007), "2024-01-03").drop("version_hash")


@query
def scd2_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """The second day brings a column that the dimension lacks and lacks one it has; every key
    comes twice in the snapshot."""
    second = _day(spark, sf, 13, 7).drop("c_name").withColumn("grade", F.col("c_custkey") % 4)
    return _merge(_first_day(spark, sf), second.unionByName(second), "2024-01-02").drop("version_hash")


@query
def reconcile_customer(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    segment = F.when(k % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    raw = _table(spark, sf, "customer").select(k, segment)
    kept = raw.where((k % 13 != 0) | (F.col("c_mktsegment") == "BUILDING"))
    return reconcile.reconcile_counts(raw, kept, ["c_mktsegment"])


@query
def evolution_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Stored data has another type for one column and a column the contract no longer has: the
    batch must not join it."""
    annotated = annotated_customers(spark, sf)
    valid = ingest.valid_rows(annotated)
    stored = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "c_acctbal" else f.dataType) for f in valid.schema.fields]
        + [T.StructField("c_nationkey", T.IntegerType())]
    )
    reason = evolution.incompatibility(stored, valid.schema, CUSTOMER.evolution)
    refused = ingest.refuse_all(annotated, reason) if reason else annotated
    return audit.reason_counts(ingest.refused_rows(refused))


# -- loan risk ---------------------------------------------------------------------------------------


def _loan_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    repayments = _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").alias("emi_number"),
        (F.col("l_quantity").cast("int") * 3 - 45).alias("days_past_due"),
    )
    loans = _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("borrower_id"),
        F.col("o_totalprice").alias("loan_amount"),
        (F.col("o_orderkey") % 48 + 12).cast("int").alias("tenure"),
        (F.col("o_totalprice") / 12).alias("emi_amount"),
    )
    borrowers = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("borrower_id"),
        F.col("c_acctbal").alias("income"),
        (F.col("c_custkey") % 551 + 300).cast("int").alias("credit_score"),
    )
    return repayments, loans, borrowers


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return risk.loan_features(*_loan_tables(spark, sf))


FIXED_WEIGHTS = {
    "late_payment_ratio": 2.0,
    "missed_payment_count": 0.35,
    "emi_income_ratio": 0.001,
    "income": -0.00002,
    "credit_score": -0.001,
}
FIXED_INTERCEPT = -2.5


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from given coefficients: a plain projection over the features."""
    probability = logistic(FIXED_WEIGHTS, FIXED_INTERCEPT)
    return with_decision(_features(spark, sf).withColumn("default_probability", probability))


@query
def loan_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf)


@query
def loan_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return risk.feature_matrix(_features(spark, sf))


@query
def loan_preview(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["loan_id", "max_days_past_due", "default_flag"]
    return risk.preview(_features(spark, sf).select(*columns), ["loan_id"])


@query
def default_counts(spark: SparkSession, sf: str) -> DataFrame:
    return risk.value_counts(_features(spark, sf), "default_flag")


@query
def default_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = risk.default_rate(_features(spark, sf))
    return rate.select(F.round("default_rate", 9).alias("default_rate"))


@query
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    cells = drivers.correlation_matrix(_features(spark, sf), [*risk.DRIVER_FEATURES, risk.LABEL])
    return cells.withColumn("correlation", F.round("correlation", 6))


def _label_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return drivers.label_correlations(_features(spark, sf), risk.DRIVER_FEATURES, risk.LABEL)


@query
def label_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return _label_correlations(spark, sf).withColumn("correlation", F.round("correlation", 6))


@query
def risk_drivers(spark: SparkSession, sf: str) -> DataFrame:
    top = drivers.risk_drivers(_label_correlations(spark, sf), risk.LABEL)
    return top.withColumn("correlation", F.round("correlation", 6))


@query
def driver_narration(spark: SparkSession, sf: str) -> DataFrame:
    return drivers.narrate(drivers.risk_drivers(_label_correlations(spark, sf), risk.LABEL))


@query
def loan_split(spark: SparkSession, sf: str) -> DataFrame:
    return with_split(_loan_tables(spark, sf)[1]).select("loan_id", "split")


@query
def loan_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(
        "loan_id",
        F.round("default_probability", 9).alias("default_probability"),
        "risk_score",
        "risk_tier",
        "decision",
    )


@query
def tier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return risk.value_counts(_scored(spark, sf), "risk_tier")


def _quality_columns(accuracy: float | None, area: float | None) -> list[Column]:
    values = {"accuracy": (accuracy, 9), "area_under_roc": (area, 6)}
    return [
        F.lit(None if value is None else round(value, digits)).cast("double").alias(name)
        for name, (value, digits) in values.items()
    ]


@query
def score_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy and area under the ROC curve of the given coefficients, on the test rows; these are
    written once because both figures read them."""
    folder = new_folder(spark, "loan-scores")
    test = with_split(_scored(spark, sf)).where(F.col("split") == "test")
    predicted = test.withColumn("prediction", (F.col("default_probability") > 0.5).cast("double"))
    predicted.select("default_probability", "prediction", risk.LABEL).write.parquet(folder)
    found = prediction_quality(spark.read.parquet(folder))
    return spark.range(1, numPartitions=1).select(*_quality_columns(*found))


@query
def incomplete_loans(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("loan_id")
    gaps = _features(spark, sf).withColumn("income", F.when(k % 6 != 0, F.col("income")))
    return incomplete_rows(gaps)


@query
def loan_model(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on the training rows, decide on all rows; the split features are written once because
    the optimiser, the evaluation and the scoring all read them."""
    folder = new_folder(spark, "loan-features")
    with_split(_features(spark, sf)).write.parquet(folder)
    marked = spark.read.parquet(folder)
    model = fit(marked.where(F.col("split") == "train"), handle_invalid="keep")
    decided = with_decision(model.predict(marked), reject_unscored=True)
    probability = F.round("default_probability", 8).alias("default_probability")
    return decided.select("loan_id", probability, "prediction", "risk_score", "risk_tier", "decision")


@query
def loan_assessment(spark: SparkSession, sf: str) -> DataFrame:
    """The loan job as a whole: quality on the test rows, and the rows per decision."""
    folder = new_folder(spark, "loan-features")
    _features(spark, sf).write.parquet(folder)
    made = assess(spark.read.parquet(folder), handle_invalid="keep")
    counts = made.scored.groupBy("decision").agg(F.count("*").alias("rows"))
    return counts.select("decision", "rows", *_quality_columns(made.accuracy, made.area_under_roc))


@query
def loan_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the fit is at its optimum: for each coefficient the gradient of the penalised
    likelihood over all training rows, against the spread of its terms."""
    folder = new_folder(spark, "loan-features")
    with_split(_features(spark, sf)).where(F.col("split") == "train").write.parquet(folder)
    train = spark.read.parquet(folder)
    model = fit(train, handle_invalid="keep")
    weights = {"intercept": 0.0, **model.coefficients}
    predicted = model.predict(train).withColumn("intercept", F.lit(1.0))
    error = F.col("default_probability") - F.col("default_flag")
    spread = F.col("default_probability") * (1 - F.col("default_probability"))
    sums = predicted.agg(
        F.count("*").alias("train_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("feature"),
                    (F.sum(error * F.col(name)) + F.lit(w)).alias("gradient"),
                    F.sqrt(F.sum(spread * F.col(name) * F.col(name))).alias("deviation"),
                )
                for name, w in weights.items()
            ]
        ).alias("parts"),
    )
    parts = sums.select("train_rows", F.inline("parts"))
    return parts.select("feature", "train_rows", (F.abs("gradient") <= 0.01 * F.col("deviation")).alias("optimal"))


@query
def loan_features_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same features from CSV files in which some cells are missing."""
    repayments, loans, borrowers = _loan_tables(spark, sf)
    folder = new_folder(spark, "loan-csv")
    gap = F.col("loan_id") % 50 == 0
    late = F.when(gap, "NaN").otherwise(F.col("days_past_due").cast("string"))
    write_csv(repayments.withColumn("days_past_due", late), f"{folder}/repayments")
    write_csv(loans, f"{folder}/loans")
    income = F.when(F.col("borrower_id") % 40 == 0, "NA").otherwise(F.col("income").cast("string"))
    write_csv(borrowers.withColumn("income", income), f"{folder}/borrowers")
    features = risk.loan_features(
        read_repayments(spark, f"{folder}/repayments"),
        read_loans(spark, f"{folder}/loans"),
        read_borrowers(spark, f"{folder}/borrowers"),
    )
    return features.select(
        "loan_id", "max_days_past_due", "late_payment_count", "total_payments", "borrower_id",
        "income", "credit_score", "tenure", "default_flag",
    )


@query
def loan_features_export(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled feature table written as CSV and read back."""
    folder = new_folder(spark, "loan-export")
    matrix = risk.feature_matrix(_features(spark, sf))
    write_csv(matrix, folder)
    return spark.read.schema(matrix.schema).option("header", True).csv(folder)


# -- synthetic deliveries ------------------------------------------------------------------------------

GENERATED_AT = "2024-01-15 08:00:00"


def _synthetic_employees(spark: SparkSession, sf: str) -> DataFrame:
    return employees(_table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), GENERATED_AT)


@query
def synthetic_employees(spark: SparkSession, sf: str) -> DataFrame:
    return _synthetic_employees(spark, sf)


@query
def synthetic_payroll(spark: SparkSession, sf: str) -> DataFrame:
    return payroll(_synthetic_employees(spark, sf).select("id", "employee_id"), GENERATED_AT)


@query
def synthetic_employee_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Generated employees through their contract."""
    annotated = ingest.annotate(_synthetic_employees(spark, sf).drop("id"), EMPLOYEE_MASTER)
    return audit.reason_counts(annotated)


@query
def synthetic_payroll_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Generated payroll rows through their contract, with the foreign key to employees."""
    people = _synthetic_employees(spark, sf)
    rows = payroll(people.select("id", "employee_id"), GENERATED_AT).drop("id")
    parents = people.where(F.col("id") % 3 != 0)
    options = ingest.Options(references=[ingest.Reference("employee_id", parents, "employee_id")])
    annotated = ingest.annotate(rows, PAYROLL_TRANSACTIONS, options=options)
    return annotated.groupBy("dq_status", "dq_failed_checks", "rejection_reason").agg(F.count("*").alias("rows"))


# -- files, zones, tables, streams ---------------------------------------------------------------------

RUN_DATE = "2024-01-15"


def _deliver_orders(spark: SparkSession, sf: str) -> str:
    """Orders as CSV files: null tokens, bad casts, and rows with a field too few or too many."""
    text = delivered_orders(spark, sf)
    folder = new_folder(spark, "landing")
    k = F.col("o_orderkey").try_cast("bigint")
    names = text.columns
    line = F.concat_ws(",", *[F.col(c) for c in names])
    short = F.concat_ws(",", *[F.col(c) for c in names[:-1]])
    line = F.when(k % 61 == 0, short).when(k % 67 == 0, F.concat(line, F.lit(",x"))).otherwise(line)
    # One column named like the header and written without quoting: plain lines, and a header
    # line in every file.
    text.select(line.alias(",".join(names))).write.options(
        header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{folder}/orders")
    return f"{folder}/orders"


def _ingest_orders(spark: SparkSession, sf: str) -> Zones:
    zones = Zones(new_folder(spark, "zones"), "orders")
    options = ingest.Options(uniform_header=True, soft_fail_threshold=0.05)
    checks = C.build_checks([C.date_range("o_day", "1996-01-01", "2003-12-31"), C.positive_number("o_totalprice", HARD)])
    ingest.ingest_files(spark, _deliver_orders(spark, sf), ORDERS, zones, RUN_DATE, checks, options, "run-1")
    return zones


@query
def csv_valid(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files through the whole job; the valid zone."""
    rows = read_partition(spark, _ingest_orders(spark, sf).valid, RUN_DATE)
    return rows.select(
        "o_orderkey",
        F.date_format("o_placed", "yyyy-MM-dd HH:mm:ss").alias("o_placed"),
        "o_custkey", "o_urgent", "o_day", "o_totalprice", "dq_status", "dq_failed_checks",
        "_pipeline_run_id", "_source_dataset", "_dt",
    )


@query
def csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The quarantine zone: both kinds of refused rows, with what was delivered."""
    rows = read_partition(spark, _ingest_orders(spark, sf).quarantine, RUN_DATE)
    return rows.select("rejection_layer", "rejection_reason", "raw_record", "pipeline_run_id")


@query
def csv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Refused rows per reason, over all delivered files; the zone keeps them per file."""
    stored = spark.read.json(f"{_ingest_orders(spark, sf).summary}/dt={RUN_DATE}")
    keys = ["dataset", "pipeline_run_id", "rejection_layer", "rejection_reason"]
    known = F.col("source_file").isNotNull() & F.col("summary_ts").isNotNull()
    return stored.where(known).groupBy(*keys).agg(F.sum("rows").alias("rows"))


@query
def quarantine_escalated(spark: SparkSession, sf: str) -> DataFrame:
    """Above the threshold, rows with soft findings are refused too, with their delivered text."""
    zones = Zones(new_folder(spark, "zones"), "customer")
    options = ingest.Options(soft_fail_threshold=0.0, escalate=True)
    ingest.ingest_frames([delivered_customers(spark, sf)], CUSTOMER, zones, RUN_DATE, options=options)
    refused = read_partition(spark, zones.quarantine, RUN_DATE)
    return refused.select(F.get_json_object("raw_record", "$.c_custkey").alias("raw_key"), "rejection_layer", "rejection_reason")


def _three_days(spark: SparkSession, sf: str) -> Zones:
    """A type change on the second and third day, and the old type again on the fourth."""
    zones = Zones(new_folder(spark, "zones"), "part")
    parts = _table(spark, sf, "part").select(F.col("p_partkey").cast("string"), F.col("p_size").cast("string"))
    for day, kind in enumerate(("STRING", "DOUBLE", "DOUBLE", "STRING"), 1):
        contract = Contract.define("part", mandatory=f"p_partkey BIGINT, p_size {kind}")
        ingest.ingest_frames([parts], contract, zones, f"2024-01-0{day}")
    return zones


@query
def evolution_three_days(spark: SparkSession, sf: str) -> DataFrame:
    """Status per day: a refused schema stays refused until the accepted one comes back."""
    return spark.read.json(_three_days(spark, sf).audit).select("run_date", "status", "valid", "schema_rejected")


@query
def quarantine_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a batch with a refused schema keep their delivered text."""
    refused = read_partition(spark, _three_days(spark, sf).quarantine, "2024-01-02")
    key = F.get_json_object("raw_record", "$.p_partkey").cast("bigint").alias("p_partkey")
    return refused.select(key, "rejection_layer", "rejection_reason")


@query
def partitioned_two_days(spark: SparkSession, sf: str) -> DataFrame:
    """A text column of digits as a partition column: the second day is accepted, its zeros stay."""
    zones = Zones(new_folder(spark, "zones"), "orders")
    contract = Contract.define("orders", mandatory="o_orderkey BIGINT, half STRING")
    half = F.lpad((F.col("o_orderkey") % 2).cast("string"), 3, "0").alias("half")
    orders = _table(spark, sf, "orders").select(F.col("o_orderkey").cast("string"), half)
    options = ingest.Options(partition_columns=["half"])
    for day in ("2024-01-01", "2024-01-02"):
        ingest.ingest_frames([orders], contract, zones, day, options=options)
    stored = read_partition(spark, zones.valid, "2024-01-02", contract.struct())
    return stored.groupBy("half").agg(F.count("*").alias("rows"))


@query
def csv_audit(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.json(f"{_ingest_orders(spark, sf).audit}/dt={RUN_DATE}").drop("errors")


def _nation_files(spark: SparkSession, sf: str) -> str:
    """Customers as one CSV file per nation."""
    folder = new_folder(spark, "nations")
    _table(spark, sf, "customer").repartition("c_nationkey").write.partitionBy("c_nationkey").option(
        "header", True
    ).csv(folder)
    return folder


def _nation(path: Column) -> Column:
    return F.regexp_extract(path, "c_nationkey=([0-9]+)", 1).cast("int")


@query
def file_rows(spark: SparkSession, sf: str) -> DataFrame:
    facts = file_facts(spark, _nation_files(spark, sf))
    return facts.groupBy(_nation(F.col("file_path")).alias("c_nationkey")).agg(
        F.sum("data_rows").alias("data_rows"), F.count("checksum").alias("files")
    )


@query
def file_verification(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests for every file, some of them tampered with, missing, or about absent files."""
    folder = _nation_files(spark, sf)
    named = F.concat(F.lit("nation_"), F.lpad(_nation(F.col("file_path")).cast("string"), 8, "0"), F.lit(".csv"))
    facts = file_facts(spark, folder).withColumn("file_name", named)
    nation = F.substring("file_name", 8, 8).cast("int")
    claims = manifest_records(facts, "v1", RUN_DATE)
    nation_of = F.substring("filename", 8, 8).cast("int")
    claims = claims.where(nation_of % 7 != 6).withColumns(
        {
            "checksum": F.when(nation_of % 5 == 0, "0").otherwise(F.col("checksum")),
            "expected_rows": F.col("expected_rows") + F.when(nation_of % 4 == 0, 1).otherwise(0),
            "file_size_bytes": F.col("file_size_bytes") + F.when(nation_of % 3 == 0, 1).otherwise(0),
        }
    )
    manifests = f"{folder}-manifests"
    claims.write.json(manifests)
    expected = _table(spark, sf, "nation").select(
        F.lit("nation").alias("dataset_name"),
        F.concat(F.lit("nation_"), F.lpad(F.col("n_nationkey").cast("string"), 8, "0"), F.lit(".csv")).alias("file_name"),
    )
    present = facts.where(nation != 11)
    verified = verify_files(expected, present, read_manifest_records(spark, manifests))
    counted = verified.withColumn("error_count", F.size("errors"))
    return counted.drop("file_path", "errors", "dataset_name")


def _order_years(spark: SparkSession, sf: str) -> list[int]:
    years = _table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    return sorted(r.y for r in years.collect())


@query
def raw_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written per date, further split by status; one date read back."""
    zone = new_folder(spark, "raw-orders")
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    for year in _order_years(spark, sf):
        write_date(orders.where(F.col("y") == year), zone, f"{year}-01-01", ["o_orderstatus"])
    return read_partition(spark, zone, "1997-01-01").drop("dt")


@query
def raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """The raw zone as a catalog table, filtered on its partition column."""
    zone = new_folder(spark, "raw-table")
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    for year in _order_years(spark, sf):
        write_date(orders.where(F.col("y") == year), zone, f"{year}-01-01")
    name = "raw_orders_" + zone[-12:]
    declare_table(spark, name, zone, read_zone(spark, zone).drop("dt").schema)
    return spark.table(name).where(F.col("dt") > F.lit("1996-06-01").cast("date")).groupBy("dt").agg(
        F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum")
    )


@query
def contract_table(spark: SparkSession, sf: str) -> DataFrame:
    """A contract document that names its database, table and a column that must not be NULL: the
    valid rows by way of the table it declares."""
    base = new_folder(spark, "contract")
    document = {
        "dataset": {"name": "customer", "database": "tidegate_raw", "table": "customer_" + base[-12:], "partition_col": "_dt"},
        "mandatory_columns": [{"name": "c_custkey", "type": "bigint"}, {"name": "c_name", "type": "string"}],
        "optional_columns": [{"name": "c_mktsegment", "type": "string", "nullable": False}, {"name": "joined", "type": "string"}],
    }
    contract = Contract.from_mapping(document)
    zones = Zones(base, "customer")
    delivered = delivered_customers(spark, sf).drop("c_acctbal")
    ingest.ingest_frames([delivered], contract, zones, RUN_DATE)
    name = declare_contract_table(spark, contract, zones, read_zone(spark, zones.valid).drop("dt").schema)
    valid = spark.table(name).where(F.col("dt") == F.lit(RUN_DATE).cast("date"))
    return valid.groupBy("c_mktsegment").agg(F.count("*").alias("rows"))


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files taken in by the stream, in both zones."""
    zones = _streamed(spark, sf)
    valid = read_partition(spark, zones.valid, RUN_DATE).select(
        F.lit("valid").alias("zone"), F.lit(None).cast("string").alias("rejection_reason")
    )
    refused = read_partition(spark, zones.quarantine, RUN_DATE).select(
        F.lit("quarantine").alias("zone"), "rejection_reason"
    )
    return valid.unionByName(refused).groupBy("zone", "rejection_reason").agg(F.count("*").alias("rows"))


def _staged_customers(spark: SparkSession, sf: str) -> Zones:
    """Two daily snapshots, delivered twice over, through raw into staging."""
    zones = Zones(new_folder(spark, "staging"), "customer")
    contract = Contract.define("customer", mandatory="c_custkey BIGINT, c_name STRING, c_mktsegment STRING")
    for day, without, changed in (("2024-01-01", 10, 1_000_000_007), ("2024-01-02", 13, 7)):
        snapshot = _day(spark, sf, without, changed)
        text = snapshot.select([F.col(c).cast("string") for c in snapshot.columns])
        ingest.ingest_frames([text.unionByName(text)], contract, zones, day)
        staging.run_staging(spark, contract, zones, day, ["c_custkey"], SCD2_TRACKED, close_missing=True)
    return zones


@query
def staging_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The same dimension as ``scd2_customer``, built through the zones."""
    zones = _staged_customers(spark, sf)
    return staging.read_dimension(spark, zones, "2024-01-02").drop("version_hash")


@query
def staging_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    zones = _staged_customers(spark, sf)
    contract = Contract.define("customer", mandatory="c_custkey BIGINT, c_name STRING, c_mktsegment STRING")
    return staging.reconcile(spark, contract, zones, "2024-01-02", ["c_mktsegment"], ["c_custkey"])


@query
def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files with different headers, read together: rows per reason."""
    folder = new_folder(spark, "headers")
    k = F.col("c_custkey").cast("bigint")
    customers = delivered_customers(spark, sf)
    third = k % 3
    write_csv(customers.where(third == 0), f"{folder}/a")
    write_csv(customers.where(third == 1).select("joined", "c_name", "c_custkey", "c_mktsegment", "c_acctbal"), f"{folder}/b")
    write_csv(customers.where(third == 2).drop("joined").withColumn("loyalty", F.col("c_custkey")), f"{folder}/c")
    files = list_files(spark, [f"{folder}/{d}" for d in "abc"])
    zones = Zones(new_folder(spark, "zones"), "customer")
    ingest.ingest_files(spark, files, CUSTOMER, zones, RUN_DATE)
    valid = read_partition(spark, zones.valid, RUN_DATE)
    refused = read_partition(spark, zones.quarantine, RUN_DATE)
    kinds = valid.select(F.lit("valid").alias("outcome"), F.col("loyalty").isNotNull().alias("has_loyalty")).unionByName(
        refused.select(F.col("rejection_reason").alias("outcome"), F.col("loyalty").isNotNull().alias("has_loyalty"))
    )
    return kinds.groupBy("outcome", "has_loyalty").agg(F.count("*").alias("rows"))


@query
def landing_folder(spark: SparkSession, sf: str) -> DataFrame:
    """One folder whose files have permuted, more and fewer columns: every value in its own column."""
    folder = new_folder(spark, "folder")
    customers = delivered_customers(spark, sf).select("c_custkey", "c_name", "c_mktsegment")
    third = F.col("c_custkey").cast("bigint") % 3
    forms = (["c_custkey", "c_name", "c_mktsegment"], ["c_mktsegment", "c_custkey", "c_name"], ["c_name", "c_custkey"])
    for n, columns in enumerate(forms):
        part = customers.where(third == n).select(*columns)
        (part if n else part.withColumn("loyalty", F.lit("x"))).write.mode("append").option("header", True).csv(folder)
    frames = read_landing(spark, folder)
    contract = Contract.define("customer", mandatory="c_custkey BIGINT, c_name STRING", optional="c_mktsegment STRING")
    annotated = ingest.annotate_all(frames, contract)
    return annotated.select("c_custkey", "c_name", "c_mktsegment", "loyalty", "rejection_reason")


def _streamed(spark: SparkSession, sf: str) -> Zones:
    landing = _deliver_orders(spark, sf)
    base = new_folder(spark, "stream")
    zones = Zones(base, "orders")
    checks = C.build_checks([C.positive_number("o_totalprice", HARD)])
    start_ingest(spark, landing, ORDERS, zones, RUN_DATE, f"{base}/checkpoint", checks).awaitTermination()
    return zones


@query
def stream_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Refused rows per reason as the stream's batches have summed them up."""
    stored = spark.read.json(f"{_streamed(spark, sf).summary}/dt={RUN_DATE}")
    return stored.groupBy("dataset", "rejection_layer", "rejection_reason").agg(F.sum("rows").alias("rows"))


@query
def stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream's batches read and wrote, all together."""
    stored = spark.read.json(f"{_streamed(spark, sf).audit}/dt={RUN_DATE}")
    return stored.groupBy("dataset", "status").agg(*[F.sum(c).alias(c) for c in ("read", "schema_rejected", "dq_failed", "valid")])


@query
def stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys that come again, within a micro-batch, in a later one, and in a later run of the stream."""
    base = new_folder(spark, "stream-unique")
    k = F.col("o_orderkey")
    orders = _table(spark, sf, "orders").select("o_orderkey")
    again = orders.where(k % 5 == 1)
    contract = Contract.define("orders", mandatory="o_orderkey BIGINT, wave INT")
    zones, options = Zones(f"{base}/zones", "orders"), ingest.Options(unique_keys=["o_orderkey"])
    waves = [orders.where(k % 4 != 0), orders.where(k % 4 == 0).unionByName(again), orders.where(k % 7 == 2)]
    for n, rows in enumerate(waves, 1):
        rows.select("o_orderkey", F.lit(n).alias("wave")).write.mode("append").option("header", True).csv(f"{base}/landing")
        start_ingest(spark, f"{base}/landing", contract, zones, RUN_DATE, f"{base}/checkpoint", None, options).awaitTermination()
    valid = read_partition(spark, zones.valid, RUN_DATE)
    return valid.groupBy("wave", "dq_failed_checks").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"))


@query
def stream_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Another type on the second day: the stream's batches are refused like those of the batch job."""
    base = new_folder(spark, "stream-evolution")
    write_csv(_table(spark, sf, "part").select("p_partkey", "p_size"), f"{base}/landing")
    zones = Zones(f"{base}/zones", "part")
    for day, kind in enumerate(("STRING", "DOUBLE"), 1):
        contract = Contract.define("part", mandatory=f"p_partkey BIGINT, p_size {kind}")
        start_ingest(spark, f"{base}/landing", contract, zones, f"2024-01-0{day}", f"{base}/checkpoint-{day}").awaitTermination()
    stored = spark.read.json(zones.audit)
    return stored.groupBy("run_date", "status").agg(F.sum("valid").alias("valid"), F.sum("schema_rejected").alias("schema_rejected"))


@query
def stream_verified(spark: SparkSession, sf: str) -> DataFrame:
    """Files and manifests that arrive apart: some manifests never come, some too late, some are broken
    or wrong.  File ``n`` comes at hour ``n``; a pair at hour 1002 lets the others' time run out."""
    base = new_folder(spark, "arrivals")
    customers = _table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n")

    def deliver(rows: DataFrame) -> None:
        rows.repartition("n").write.mode("append").partitionBy("n").option("header", True).csv(f"{base}/files")

    def number(path: Column) -> Column:
        return F.regexp_extract(path, "/n=([0-9]+)/", 1).cast("int")

    def name(path: Column) -> Column:
        return F.concat(F.lit("nation_"), F.lpad(number(path).cast("string"), 8, "0"), F.lit(".csv"))

    def claim(of: str) -> None:
        facts = file_facts(spark, f"{base}/files/{of}").withColumn("n", number(F.col("file_path")))
        claims = manifest_records(facts.withColumn("file_name", name(F.col("file_path"))), "v1", RUN_DATE)
        claims = claims.withColumns(
            {
                "n": F.substring("filename", 8, 8).cast("int"),
                "checksum": F.when(F.substring("filename", 8, 8).cast("int") % 5 == 0, "0").otherwise(F.col("checksum")),
            }
        )
        document = F.when(F.col("n") % 11 == 3, "{broken").otherwise(F.to_json(F.struct(*[c for c in claims.columns if c != "n"])))
        sent = claims.where(F.col("n") % 7 != 6).select("n", document.alias("value")).repartition("n")
        sent.write.mode("append").partitionBy("n").text(f"{base}/manifests")

    def hour(path: Column, later: Column) -> Column:
        seconds = (number(path) + later) * 3600
        return F.timestamp_seconds(F.unix_timestamp(F.lit(f"{RUN_DATE} 00:00:00")) + seconds)

    path = F.col("_metadata.file_path")

    def verify() -> None:
        files = stream_files(spark, f"{base}/files", "*.csv", name(path), hour(path, F.lit(0)))
        late = F.when(number(path) % 4 == 1, 10).otherwise(1)
        manifests = stream_manifests(spark, f"{base}/manifests", "*.txt", name(path), hour(path, late))
        paired = pair_arrivals(files, manifests)
        start_verification(paired, f"{base}/verdicts", f"{base}/checkpoint", F.lit("nation")).awaitTermination()

    deliver(customers)
    claim("*")
    verify()
    deliver(customers.limit(1).withColumn("n", F.lit(1002)))
    claim("n=1002")
    verify()
    verdicts = read_verdicts(spark, f"{base}/verdicts").where(F.col("file_name") < "nation_00001000.csv")
    counted = verdicts.withColumn("error_count", F.size("errors"))
    return counted.drop("file_path", "errors", "dataset_name", "batch")


def _place_files(spark: SparkSession, folder: str, names: dict[str, str]) -> None:
    """Move the single part file of each folder ``<folder>/<key>`` to the path that ``names`` gives it."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for key, path in names.items():
        (part,) = [s.getPath() for s in files.listStatus(jvm.Path(f"{folder}/{key}")) if s.getPath().getName().startswith("part-")]
        target = jvm.Path(path)
        files.mkdirs(target.getParent())
        files.delete(target, False)
        if not files.rename(part, target):
            raise OSError(f"cannot move {part} to {path}")


def _deliver_nations(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """One file per nation under its delivery name, with its manifest beside it, and what is expected.

    Names of every sixth lack the date, every seventh has no manifest, every fifth a broken one; the
    file of nation 8 is empty.
    """
    folder = new_folder(spark, "delivered")
    customers = _table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n")
    customers.where("n <> 8").repartition("n").write.partitionBy("n").option("header", True).csv(f"{folder}/parts")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{folder}/parts/n=8")
    keys = sorted({r.n for r in customers.select("n").distinct().collect()} | {8})
    names = {n: f"nation_{n if n % 6 == 0 else f'{n:08d}'}.csv" for n in keys}
    _place_files(spark, f"{folder}/parts", {f"n={n}": f"{folder}/landing/{name}" for n, name in names.items()})
    facts = file_facts(spark, f"{folder}/landing")
    claims = manifest_records(facts, "v1", RUN_DATE).withColumn("n", F.regexp_extract("filename", "([0-9]+)", 1).cast("int"))
    document = F.when(F.col("n") % 5 == 4, '{"checksum": ').otherwise(F.to_json(F.struct(*[c for c in claims.columns if c != "n"])))
    sent = claims.where("n % 7 <> 3").select("n", document.alias("value"))
    sent.repartition("n").write.partitionBy("n").text(f"{folder}/documents")
    manifests = {f"n={n}": f"{folder}/landing/{name[:-4]}_manifest.json" for n, name in names.items() if n % 7 != 3}
    _place_files(spark, f"{folder}/documents", manifests)
    expected = spark.createDataFrame([("nation", name) for name in names.values()], "dataset_name string, file_name string")
    return f"{folder}/landing", expected


@query
def delivery_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Files and manifest documents as they lie in a landing folder: bad names, broken and missing
    documents, an empty file."""
    landing, expected = _deliver_nations(spark, sf)
    verified = verify_files(expected, file_facts(spark, landing), read_manifests(spark, landing))
    return verified.withColumn("error_count", F.size("errors")).drop("file_path", "errors", "dataset_name")


def _delivered_datasets(spark: SparkSession, sf: str) -> tuple[str, list[Contract]]:
    """Deliveries of five datasets of one day: in order, with a row too many claimed, with a broken
    manifest, without one, and not at all."""
    folder = new_folder(spark, "delivered")
    stamp = RUN_DATE.replace("-", "")
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "region": "r_regionkey"}
    for name, key in keys.items():
        value = F.when(F.col(key) % 10 == 3, "x").otherwise(F.col(key).cast("string")).alias("id")
        _table(spark, sf, name).select(value).coalesce(1).write.option("header", True).csv(f"{folder}/parts/{name}")
    _place_files(spark, f"{folder}/parts", {n: f"{folder}/landing/{n}/{n}_{stamp}.csv" for n in keys})
    _claim(spark, folder, {"customer": 0, "part": 1, "supplier": None})
    contracts = [Contract.define(n, mandatory="id BIGINT") for n in (*keys, "nation")]
    return folder, contracts


def _claim(spark: SparkSession, folder: str, claims: dict[str, int | None]) -> None:
    """Manifests of datasets: with so many rows too many, or broken."""
    made = new_folder(spark, "manifests")
    for name, more in claims.items():
        records = manifest_records(file_facts(spark, f"{folder}/landing/{name}"), "v1", RUN_DATE)
        if more is None:
            text = records.select(F.lit("{broken").alias("value"))
        else:
            wrong = records.withColumn("expected_rows", F.col("expected_rows") + more)
            text = wrong.select(F.to_json(F.struct(*wrong.columns)).alias("value"))
        text.coalesce(1).write.text(f"{made}/{name}")
    stamp = RUN_DATE.replace("-", "")
    _place_files(spark, made, {n: f"{folder}/landing/{n}/{n}_{stamp}_manifest.json" for n in claims})


def _audited(spark: SparkSession, folder: str, contracts: list[Contract], run: int) -> DataFrame:
    """What the audit says of each dataset, and the rows that its valid zone holds."""
    rows = []
    for contract in contracts:
        zones = Zones(f"{folder}/lake", contract.name)
        (said,) = spark.read.json(f"{zones.audit}/dt={RUN_DATE}").collect()
        held = read_partition(spark, zones.valid, RUN_DATE).count() if exists(spark, f"{zones.valid}/dt={RUN_DATE}") else 0
        kinds = ",".join(e.partition(":")[0] for e in said["errors"].split("; "))
        rows.append((run, contract.name, said["status"], said["read"], said["valid"], held, kinds))
    return spark.createDataFrame(rows, "run int, dataset string, status string, read long, valid long, held long, errors string")


@query
def deliveries_job(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job of five datasets, twice: the second time the manifest of the first dataset is
    wrong, so that its date is emptied, and that of the second is right."""
    folder, contracts = _delivered_datasets(spark, sf)
    ingest.ingest_deliveries(spark, f"{folder}/landing", contracts, f"{folder}/lake", RUN_DATE)
    first = _audited(spark, folder, contracts, 1)
    _claim(spark, folder, {"customer": 5, "part": 0})
    ingest.ingest_deliveries(spark, f"{folder}/landing", contracts, f"{folder}/lake", RUN_DATE)
    return first.unionByName(_audited(spark, folder, contracts, 2))


@query
def delivery_job(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job of single datasets: one that passes, one that fails, one that is not there."""
    folder, contracts = _delivered_datasets(spark, sf)
    for contract in contracts:
        ingest.ingest_delivery(spark, f"{folder}/landing", contract, Zones(f"{folder}/lake", contract.name), RUN_DATE)
    return _audited(spark, folder, contracts, 1)


@query
def contract_table_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A contract whose table has another partition column than the folders; the third date is added
    to the declared table by itself."""
    base = new_folder(spark, "contract")
    document = {
        "dataset": {"name": "orders", "database": "tidegate_raw", "table": "orders_" + base[-12:], "partition_col": "load_date"},
        "mandatory_columns": [{"name": "o_orderkey", "type": "bigint"}],
    }
    contract, zones = Contract.from_mapping(document), Zones(base, "orders")
    keys = _table(spark, sf, "orders").select("o_orderkey")
    name = None
    for day in (1, 2, 3):
        run_date = f"2024-01-0{day}"
        rows = keys.where(F.col("o_orderkey") % 4 >= day).select(F.col("o_orderkey").cast("string"))
        ingest.ingest_frames([rows], contract, zones, run_date)
        if day == 2:
            schema = read_partition(spark, zones.valid, run_date).drop("dt").schema
            name = declare_contract_table(spark, contract, zones, schema)
        if day == 3:
            add_table_date(spark, name, zones.valid, run_date, "load_date")
    return spark.table(name).groupBy("load_date").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"))


@query
def scd2_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The second day comes after the third: the same dimension as ``scd2_three_days``."""
    second, third = _day(spark, sf, 13, 7), _day(spark, sf, 17, 1_000_000_007)
    known = _merge(_first_day(spark, sf), third, "2024-01-03")
    late = scd2.backfill(known, second, third, ["c_custkey"], SCD2_TRACKED, "2024-01-02", "2024-01-03")
    return late.drop("version_hash")
