from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidegate.contract import CORRUPT_COLUMN, Contract
from tidegate.functions.text import NULL_TOKENS, blank_to_null
from tidegate.operators.enforce import cleanse, diff_columns, enforce, schema_rejected, schema_valid

CONTRACT = Contract.define(
    "t",
    mandatory="id BIGINT, name STRING",
    optional="amount DOUBLE, n INT, day DATE, at TIMESTAMP, ok BOOLEAN, phone STRING, ssn STRING",
    details={
        "phone": {"cleansing": "strip_non_numeric_except_plus"},
        "ssn": {"cleansing": "remove_dashes_and_spaces"},
    },
)
NAMES = CONTRACT.names


def frame(spark, *rows, names=NAMES):
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"`{n}` string" for n in names))


def one(spark, **values):
    return enforce(frame(spark, {"id": "1", "name": "x", **values}), CONTRACT).first()


def test_null_tokens_are_exact_and_kept_values_untrimmed(spark):
    texts = [*NULL_TOKENS, *[f"  {t} " for t in NULL_TOKENS]]
    kept = ["Null", "NONE", "\t", " x ", "NA,N/A", ",", "nul", "N", "na"]
    rows = spark.createDataFrame([(t,) for t in texts + kept] + [(None,)], "c string")
    got = [r[0] for r in rows.select(blank_to_null(F.col("c"))).collect()]
    assert got == [None] * len(texts) + kept + [None]


@pytest.mark.parametrize(
    ("column", "text", "value"),
    [
        ("n", "7", 7), ("n", " 7 ", 7), ("n", "1.5", None), ("n", "12abc", None),
        ("n", "99999999999", None), ("amount", "1e3", 1000.0), ("amount", "12abc", None),
        ("day", "2024-1-5", None), ("day", "2024-13-01", None), ("day", "2024-01-05 10:00", None),
        ("at", "2024-01-05", None), ("ok", "maybe", None), ("ok", "Yes", True), ("ok", "0", False),
    ],
)
def test_casts_never_raise(spark, column, text, value):
    row = one(spark, **{column: text})
    assert row[column] == value
    assert row["rejection_reason"] == (None if value is not None else f"TYPE_CAST_FAIL:{column}")


def test_dates_and_timestamps(spark):
    row = one(spark, day="2024-01-05", at="2024-01-05 10:11:12")
    assert str(row["day"]) == "2024-01-05" and str(row["at"]) == "2024-01-05 10:11:12"


def test_first_reason_wins(spark):
    names = [*NAMES, CORRUPT_COLUMN]
    rows = [
        {"id": "1", "name": None, "n": "x", CORRUPT_COLUMN: "1,"},
        {"id": "1", "name": " NA ", "n": "x"},
        {"id": "one", "name": "a", "n": "x"},
        {"id": "1", "name": "a", "n": "x", "amount": "y"},
    ]
    got = [r["rejection_reason"] for r in enforce(frame(spark, *rows, names=names), CONTRACT).collect()]
    assert got == ["CORRUPT_CSV_ROW", "NULL_MANDATORY:name", "NULL_MANDATORY:id", "TYPE_CAST_FAIL:amount"]


def test_rejected_rows_keep_what_was_delivered(spark):
    bad, good = one(spark, n="12abc", day=" NA "), one(spark, n="1")
    assert json.loads(bad["raw_record"]) == {"id": "1", "name": "x", "n": "12abc", "day": " NA "}
    assert good["raw_record"] is None


def test_additive_and_missing_columns(spark):
    df = frame(spark, {"id": "1", "name": "a", "zip.code": " none "}, {"id": "2", "name": "b", "zip.code": " 9 "}, names=["zip.code", "name", "id"])
    diff = diff_columns(df.columns, CONTRACT)
    assert diff.additive == ["zip.code"] and diff.missing_mandatory == []
    assert diff.missing_optional == sorted(NAMES[2:])
    out = enforce(df, CONTRACT)
    assert [r["zip.code"] for r in out.collect()] == [None, " 9 "]
    assert dict(out.dtypes)["day"] == "date" and out.where("day is not null").count() == 0
    assert out.schema["zip.code"].metadata == {"additive": True}


def test_missing_mandatory_column_refuses_the_batch(spark):
    df = frame(spark, {"id": "1", "n": "3"}, {"id": "2", "n": "x"}, names=["id", "n"])
    out = enforce(df, CONTRACT)
    assert {r["rejection_reason"] for r in out.collect()} == {"MISSING_MANDATORY_COLUMNS:name"}
    assert schema_valid(out).count() == 0 and schema_rejected(out).count() == 2


def test_case_variant_refuses_the_batch(spark):
    df = frame(spark, {"id": "1", "name": "a", "DAY": "2024-01-01"}, names=["id", "name", "DAY"])
    row = enforce(df, CONTRACT).first()
    assert row["rejection_reason"] == "AMBIGUOUS_COLUMNS:DAY"
    assert json.loads(row["raw_record"])["DAY"] == "2024-01-01"


def test_null_rejection_can_be_switched_off(spark):
    contract = Contract.from_mapping(
        {
            "dataset": {"name": "t"},
            "mandatory_columns": [{"name": "id", "type": "StringType"}, {"name": "note", "type": "StringType", "reject_if_null": False}],
        }
    )
    df = frame(spark, {"id": "1", "note": ""}, {"id": "", "note": "x"}, names=["id", "note"])
    assert [r["rejection_reason"] for r in enforce(df, contract).collect()] == [None, "NULL_MANDATORY:id"]


def test_split_keeps_every_row(spark):
    rows = [{"id": str(i) if i % 3 else "x", "name": "a" if i % 5 else "NA", "n": str(i)} for i in range(200)]
    df = frame(spark, *rows)
    results = []
    for parts in (1, 7):
        out = enforce(df.repartition(parts), CONTRACT)
        assert schema_valid(out).count() + schema_rejected(out).count() == 200
        results.append(sorted(map(str, out.collect())))
    assert results[0] == results[1]


def test_cleansing(spark):
    row = cleanse(frame(spark, {"phone": "+91-98 (7)x", "ssn": "12-34 5\t6", "id": "1-1"}), CONTRACT).first()
    assert (row["phone"], row["ssn"], row["id"]) == ("+91987", "123456", "1-1")


def test_one_projection_chain_without_shuffle(spark):
    plan = enforce(frame(spark, {"id": "1"}), CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Project") <= 4


def test_splitting_does_not_repeat_the_work(spark, tmp_path):
    """The filter on the outcome reads a finished column instead of computing it again."""
    frame(spark, {"id": "1", "name": "a"}).write.parquet(str(tmp_path / "t"))
    valid = schema_valid(enforce(spark.read.parquet(str(tmp_path / "t")), CONTRACT))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-*()0123456789").startswith("Filter")]
    assert filters and all("rejection_reason" in f and "cast(" not in f.lower() for f in filters)


def test_additive_names_like_run_context_are_refused():
    contract = Contract.define("people", mandatory="id BIGINT")
    for name in ("_dt_x", "_Raw_more", "dq_status_old", "_pipeline_step"):
        assert diff_columns(["id", name], contract).blocking_reason == f"AMBIGUOUS_COLUMNS:{name}"
    assert diff_columns(["id", "dt_x", "raw_more"], contract).blocking_reason is None
