from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate.contract import HARD, SOFT, Rule
from tidegate.functions import checks as C
from tidegate.operators.quality import (
    apply_checks,
    exists_check,
    failures_per_check,
    flag_duplicates,
    flag_orphans,
    orphans,
    status_profile,
    unique_check,
)
from tidegate.operators.skew import hot_keys, salted_join


def outcome(spark, value, kind, rule):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return apply_checks(df, C.build_checks([rule])).first()["dq_failed_checks"]


@pytest.mark.parametrize(
    ("kind", "rule", "good", "bad", "name"),
    [
        ("string", C.allowed_values("c", ["a", "b"]), "a", "A", "c__allowed_values"),
        ("string", C.regex_match("c", "b+"), "abba", "aca", "c__regex"),
        ("string", C.min_length("c", 3), "abc", "ab", "c__min_length"),
        ("double", C.positive_number("c"), 0.01, 0.0, "c__positive"),
        ("double", C.positive_number("c"), 1.0, float("nan"), "c__positive"),
        ("int", C.positive_number("c"), 1, -1, "c__positive"),
    ],
)
def test_checks(spark, kind, rule, good, bad, name):
    assert outcome(spark, good, kind, rule) == ""
    assert outcome(spark, None, kind, rule) == ""
    assert outcome(spark, bad, kind, rule) == name


def test_dates(spark):
    df = spark.sql("select * from values (date'2024-01-01'), (date'2024-01-02'), (null), (date'2024-01-03') as t(c)")
    late = C.build_checks([C.date_not_future("c")], as_of="2024-01-02")
    within = C.build_checks([C.date_range("c", "2024-01-02", "2024-01-03")])
    assert [r["dq_status"] for r in apply_checks(df, late).collect()] == ["PASS", "PASS", "PASS", "WARN"]
    assert [r["dq_status"] for r in apply_checks(df, within).collect()] == ["WARN", "PASS", "PASS", "PASS"]
    today = C.build_checks([C.date_not_future("c")])
    df = spark.range(1).select(F.explode(F.array(F.current_date(), F.date_add(F.current_date(), 1))).alias("c"))
    assert [r["dq_status"] for r in apply_checks(df, today).collect()] == ["PASS", "WARN"]


def test_hard_failures_come_first_and_repeated_kinds_keep_their_names(spark):
    rules = [
        C.regex_match("c", "a"),
        C.regex_match("c", "b"),
        C.allowed_values("c", ["ok"], HARD),
        C.not_null("d"),
        Rule("c", "date_format"),
    ]
    df = spark.createDataFrame([("x", None), ("ab", 1), ("b", None)], "c string, d int")
    rows = apply_checks(df, C.build_checks(rules)).collect()
    assert [r["dq_failed_checks"] for r in rows] == [
        "c__allowed_values|d__not_null|c__regex|c__regex_2",
        "c__allowed_values",
        "c__allowed_values|d__not_null|c__regex",
    ]
    assert [(r["dq_status"], r["validation_flag"]) for r in rows] == [("FAIL", 0)] * 3


def test_statuses_and_profile(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", None), ("a", 1)], "c string, d int")
    checks = C.build_checks([C.allowed_values("c", ["a"]), C.not_null("d")])
    checked = apply_checks(df, checks)
    assert [r["dq_status"] for r in checked.collect()] == ["PASS", "WARN", "FAIL", "PASS"]
    row = status_profile(checked, 0.49).first()
    assert row.asDict() == {"total": 4, "passed": 2, "warned": 1, "failed": 1, "finding_share": 0.5, "breach": True}
    assert not status_profile(checked, 0.5).first()["breach"]
    empty = status_profile(checked.limit(0), 0.05).first()
    assert empty["total"] == 0 and empty["breach"] is False
    per = {r["check_name"]: (r["severity"], r["failed_rows"]) for r in failures_per_check(df, checks).collect()}
    assert per == {"c__allowed_values": (SOFT, 1), "d__not_null": (HARD, 1)}


def test_no_checks(spark):
    row = apply_checks(spark.range(1), []).first()
    assert (row["dq_status"], row["dq_failed_checks"], row["validation_flag"]) == ("PASS", "", 1)


def test_rows_outside_where_are_not_judged(spark):
    df = spark.createDataFrame([(None,), (1,)], "c int")
    rows = apply_checks(df, C.build_checks([C.not_null("c")]), where=F.col("c") > 0).collect()
    assert [r["dq_status"] for r in rows] == [None, "PASS"]
    assert [r["validation_flag"] for r in rows] == [None, 1]


def test_unknown_check_is_an_error_and_kinds_can_be_added(spark):
    with pytest.raises(ValueError):
        C.build_checks([Rule("c", "no_such")])
    C.register_kind("even_test", "even", lambda c, p: c % 2 == 0)
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    got = apply_checks(df, C.build_checks([Rule("c", "even_test")])).collect()
    assert [r["dq_failed_checks"] for r in got] == ["c__even", "", ""]
    with pytest.raises(ValueError):
        C.register_kind("even_test", "even", lambda c, p: c > 0)


def test_gross_salary_consistency(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (None, 1.0), (1.0, None)], "gross_salary double, basic_salary double")
    got = apply_checks(df, C.build_checks([C.gross_salary_consistency()])).collect()
    assert [r["dq_failed_checks"] for r in got] == ["", "gross_salary__ge_basic", "", ""]


def test_duplicates_with_a_hot_key(spark):
    """A third of the rows share one key; spreading must change nothing."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") - F.col("id") % 4).alias("k"),
        F.col("id"),
    )
    expected = {}
    for r in df.collect():
        expected.setdefault(r["k"], []).append(r["id"])
    for min_rows in (10, 10**9):
        got = flag_duplicates(df, ["k"], min_rows=min_rows).collect()
        assert len(got) == 3000
        for r in got:
            assert r["_is_repeated"] == (r["k"] is not None and len(expected[r["k"]]) > 1)
    checked = apply_checks(flag_duplicates(df, ["k"]), [unique_check(["k"], severity=HARD)])
    assert {r["dq_failed_checks"] for r in checked.collect()} == {"", "k__unique"}


def test_orphans_with_a_hot_key(spark):
    child = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("fk"), "id"
    )
    parent = spark.range(1000).select(F.explode(F.array("id", "id")).alias("pk")).where("pk % 2 = 0")
    parents = {r["pk"] for r in parent.collect()}
    expected = {r["id"] for r in child.collect() if r["fk"] is not None and r["fk"] not in parents}
    for min_rows in (10, 10**9):
        assert {r["id"] for r in orphans(child, parent, "fk", "pk", min_rows).collect()} == expected
        flagged = flag_orphans(child, parent, "fk", "pk", min_rows=min_rows)
        assert flagged.count() == 2000
        checked = apply_checks(flagged, [exists_check("fk")])
        assert {r["id"] for r in checked.where("dq_failed_checks = 'fk__exists'").collect()} == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, how, null_safe):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40).alias("k"), "id")
    right = spark.createDataFrame([(5, "a"), (5, "b"), (6, "c"), (None, "d"), (99, "e")], "k bigint, v string")
    r = right.withColumnRenamed("k", "rk")
    on = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    plain = left.join(r, on, how).drop("rk")
    salted = salted_join(left, right, ["k"], how, null_safe=null_safe, min_rows=100, salts=4)
    assert salted.columns == plain.columns
    key = lambda row: str(row)
    assert sorted(salted.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert hot_keys(df, ["k"], min_rows=1000).count() == 1
    assert hot_keys(df, ["k"], min_rows=10**9).count() == 0
    assert hot_keys(df, ["k"], min_rows=1).count() <= 1000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize(
    ("a", "b"), [("int", "bigint"), ("bigint", "int"), ("date", "timestamp"), ("string", "int"), ("decimal(9,2)", "decimal(12,4)")]
)
def test_salted_join_of_unlike_types(spark, how, a, b):
    def as_type(column, kind):
        return F.date_add(F.lit("2024-01-01").cast("date"), column.cast("int")).cast(kind) if kind in ("date", "timestamp") else column.cast(kind)

    left = spark.range(300).select(
        as_type(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40), a).alias("k"), "id"
    )
    right = spark.range(4, 9).select(as_type(F.col("id"), b).alias("k"), F.col("id").alias("v"))
    plain = left.join(right.withColumnRenamed("k", "rk"), F.col("k") == F.col("rk"), how).drop("rk")
    salted = salted_join(left, right, ["k"], how, min_rows=1)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_rows_without_key_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(8000, numPartitions=4).select(F.when(F.col("id") % 100 == 0, F.col("id")).alias("k"))
        flagged = flag_duplicates(rows, ["k"])
        sizes = [len(p) for p in flagged.rdd.glom().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
