from __future__ import annotations

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from tidegate.contract import Contract
from tidegate.functions.hashing import hash_bucket
from tidegate.operators.audit import add_audit_columns, add_row_hash
from tidegate.operators.dedup import drop_repeated_rows, latest_per_key
from tidegate.operators.evolution import compare_schemas
from tidegate.operators.reconcile import reconcile_counts
from tidegate.operators.scd2 import as_of, backfill, merge, open_versions
from tidegate.plans.ingest import ingest_frames
from tidegate.plans.staging import read_current, read_dimension, reconcile, run_staging
from tidegate.sinks.zones import Zones

D1, D2, D3, D4 = (f"2024-01-0{i}" for i in (1, 2, 3, 4))


def snapshot(spark, **rows):
    return spark.createDataFrame([(k, v, "n") for k, v in rows.items()], "id string, v string, note string")


def versions(df):
    return sorted(
        (r["id"], r["v"], str(r["effective_from"]), str(r["effective_to"]), r["is_current"]) for r in df.collect()
    )


def advance(dim, snap, day, close=True):
    return merge(dim, snap, ["id"], ["v"], day, close_missing=close)


def test_life_of_a_dimension(spark):
    dim = open_versions(snapshot(spark, a="1", b="1", c="1"), ["v"], D1)
    dim = advance(dim, snapshot(spark, a="1", b="2", d="1"), D2)
    assert versions(dim) == [
        ("a", "1", D1, "None", True),
        ("b", "1", D1, D2, False),
        ("b", "2", D2, "None", True),
        ("c", "1", D1, D2, False),
        ("d", "1", D2, "None", True),
    ]
    dim = advance(dim, snapshot(spark, a="1", b="1", c="1", d="1"), D3)
    got = versions(dim)
    assert ("b", "2", D2, D3, False) in got and ("b", "1", D3, "None", True) in got
    assert ("c", "1", D3, "None", True) in got and len(got) == 7
    again = advance(dim, snapshot(spark, a="1", b="1", c="1", d="1"), D3)
    assert versions(again) == got
    # at most one open version per key, and no overlap
    by_key: dict[str, list] = {}
    for k, _, start, end, is_open in got:
        by_key.setdefault(k, []).append((start, end, is_open))
    for spans in by_key.values():
        spans.sort()
        assert sum(s[2] for s in spans) <= 1
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sorted(r["id"] + r["v"] for r in as_of(dim, D2).collect()) == ["a1", "b2", "d1"]


def test_missing_rows_stay_open_unless_asked(spark):
    dim = open_versions(snapshot(spark, a="1", b="1"), ["v"], D1)
    assert len(versions(advance(dim, snapshot(spark, a="1"), D2, close=False))) == 2
    assert all(v[4] for v in versions(advance(dim, snapshot(spark, a="1"), D2, close=False)))


def test_rerun_with_other_content_replaces_the_day(spark):
    first = open_versions(snapshot(spark, a="1", b="1"), ["v"], D1)
    wrong = advance(first, snapshot(spark, a="9", c="1"), D2)
    right = advance(wrong, snapshot(spark, a="1", b="2"), D2)
    assert versions(right) == versions(advance(first, snapshot(spark, a="1", b="2"), D2))


def test_untracked_change_is_no_new_version(spark):
    dim = open_versions(snapshot(spark, a="1"), ["v"], D1)
    other = snapshot(spark, a="1").withColumn("note", F.lit("m"))
    assert versions(advance(dim, other, D2)) == versions(dim)


@pytest.mark.parametrize("late", [D2, D3])
def test_a_late_day_gives_what_the_order_gives(spark, late):
    """Every life of a key over four days: absent, or one of two values."""
    lives = list(itertools.product(["", "1", "2"], repeat=4))
    days = [
        spark.createDataFrame(
            [(f"k{i}", life[d], f"note {d}") for i, life in enumerate(lives) if life[d]] + [(None, "1", f"null {d}")],
            "id string, v string, note string",
        )
        for d in range(4)
    ]
    names = [D1, D2, D3, D4]

    def taken(order):
        dim = open_versions(days[0], ["v"], D1)
        for d in order:
            dim = advance(dim, days[d], names[d])
        return dim

    at = names.index(late)
    rest = [d for d in (1, 2, 3) if d != at]
    got = backfill(taken(rest), days[at], days[at + 1], ["id"], ["v"], late, names[at + 1])
    want = taken([1, 2, 3])

    def whole(dim):
        return sorted(tuple(map(str, (r[c] for c in want.columns))) for r in dim.collect())

    assert whole(got) == whole(want)


def test_null_keys_are_a_key(spark):
    one = spark.createDataFrame([(None, "1", "n"), ("a", "1", "n")], "id string, v string, note string")
    dim = advance(open_versions(one, ["v"], D1), one, D2)
    assert dim.count() == 2


def test_merge_shuffles_each_side_once(spark, tmp_path):
    open_versions(snapshot(spark, a="1"), ["v"], D1).write.parquet(str(tmp_path / "d"))
    snapshot(spark, a="1").write.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = advance(spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "s")), D2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_groups_before_the_shuffle(spark):
    rows = add_row_hash(spark.range(1000).select((F.col("id") % 10).alias("k")))
    rows = rows.withColumns({"_raw_load_ts": F.lit(1), "_pipeline_run_id": F.lit("a")})
    unique = drop_repeated_rows(rows)
    assert unique.count() == 10
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    last = latest_per_key(spark.range(100).select((F.col("id") % 7).alias("k"), "id"), ["k"], [F.desc("id")])
    assert sorted(r["id"] for r in last.collect()) == list(range(93, 100))


def test_row_hash_columns(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, _source_file string")
    base = add_row_hash(df).first()["_row_md5"]
    assert base == spark.sql("select md5('1|NULL')").first()[0]
    audited = add_audit_columns(df, "d", "2024-01-01", "r").first()
    assert audited["_row_md5"] == base and audited["_pipeline_run_id"] == "r"
    assert add_row_hash(df, ["a"]).first()["_row_md5"] == spark.sql("select md5('1')").first()[0]


def test_reconcile(spark):
    raw = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string")
    staged = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("c",)], "g string")
    got = {r["g"]: (r["raw_rows"], r["staging_rows"], r["diff"], r["status"]) for r in reconcile_counts(raw, staged, ["g"]).collect()}
    assert got == {"a": (2, 2, 0, "MATCH"), None: (1, 2, -1, "MISMATCH"), "b": (1, 0, 1, "MISMATCH"), "c": (0, 1, -1, "MISMATCH")}


def test_schema_changes(spark):
    old = spark.createDataFrame([], "a int, b string, _dt string, dq_status string").schema
    new = spark.createDataFrame([], "a bigint, c string").schema
    change = compare_schemas(old, new)
    assert (change.added, change.removed, change.retyped) == (["c"], ["b"], ["a"])


def test_buckets_do_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    one = df.repartition(1).select("id", hash_bucket(F.col("id"), 42).alias("b"))
    many = df.repartition(9).select("id", hash_bucket(F.col("id"), 42).alias("b"))
    assert sorted(one.collect()) == sorted(many.collect())
    share = one.where("b < 2").count() / 2000
    assert 0.17 < share < 0.23


CONTRACT = Contract.define(
    "people",
    mandatory="id STRING, department STRING",
    optional="phone STRING",
    details={"phone": {"cleansing": "strip_non_numeric_except_plus"}},
)


def test_raw_to_staging(spark, tmp_path):
    zones = Zones(str(tmp_path), "people")

    def day(date, *rows):
        df = spark.createDataFrame(list(rows), "id string, department string, phone string")
        ingest_frames([df], CONTRACT, zones, date)
        run_staging(spark, CONTRACT, zones, date, ["id"], ["department"], close_missing=True)

    day(D1, ("a", "HR", "1-2"), ("a", "HR", "1-2"), ("b", "HR", None), (None, "HR", None))
    assert {r["id"]: r["phone"] for r in read_current(spark, zones, D1).collect()} == {"a": "12", "b": None}
    for _ in range(2):
        day(D2, ("a", "IT", "1-2"), ("c", "HR", None))
        dim = read_dimension(spark, zones, D2)
        got = sorted((r["id"], r["department"], str(r["effective_from"]), str(r["effective_to"])) for r in dim.collect())
        assert got == [
            ("a", "HR", D1, D2), ("a", "IT", D2, "None"), ("b", "HR", D1, D2), ("c", "HR", D2, "None")
        ]
    assert read_dimension(spark, zones, D1).count() == 2
    report = reconcile(spark, CONTRACT, zones, D2, ["department"], ["id"]).collect()
    assert {r["department"]: r["status"] for r in report} == {"IT": "MATCH", "HR": "MATCH"}
    with pytest.raises(ValueError):
        run_staging(spark, CONTRACT, zones, "02.01.2024", ["id"], ["department"])


def test_dates_stay_dates(spark):
    dim = open_versions(snapshot(spark, a="1"), ["v"], D1)
    assert advance(dim, snapshot(spark, a="2"), D4).where("not is_current").first()["effective_to"] == datetime.date(2024, 1, 4)
