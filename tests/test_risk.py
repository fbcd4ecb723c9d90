from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import pytest
from comparison import connect, difference
from pyspark.sql import functions as F

from tidegate.functions.scoring import decision, logistic, risk_score, risk_tier
from tidegate.operators.drivers import correlation_matrix, label_correlations, narrate, risk_drivers
from tidegate.operators.model import fit, incomplete_rows, prediction_quality, with_split
from tidegate.operators.risk import default_rate, loan_features, preview, repayment_features, value_counts
from tidegate.plans.oracles import all_oracles
from tidegate.plans.queries import all_queries
from tidegate.plans.risk import assess
from tidegate.sources.loans import read_borrowers, read_loans, read_repayments


def test_repayment_edges(spark):
    rows = [("a", i, d) for i, d in enumerate([0.0, 1.0, 29.0, 30.0, 89.0, 90.0, None])]
    rows += [("b", 1, 89.0), ("c", None, None), (None, 1, 5.0)]
    df = spark.createDataFrame(rows, "loan_id string, emi_number int, days_past_due double")
    got = {r["loan_id"]: r for r in repayment_features(df).collect()}
    assert set(got) == {"a", "b", "c"}
    a = got["a"]
    assert (a["late_payment_count"], a["missed_payment_count"], a["total_payments"]) == (5, 3, 7)
    assert a["max_days_past_due"] == 90 and a["avg_days_past_due"] == pytest.approx(239 / 6)
    assert a["late_payment_ratio"] == 5 / 7
    assert got["c"]["total_payments"] == 0 and got["c"]["late_payment_ratio"] is None


def _loans(spark):
    repay = spark.createDataFrame(
        [("l1", 1, 90.0), ("l2", 1, 89.0), ("l3", 1, None), ("l4", 1, 1.0), ("l9", 1, 1.0)],
        "loan_id string, emi_number int, days_past_due double",
    )
    loans = spark.createDataFrame(
        [("l1", "b1", 10.0, 5), ("l2", "b2", 10.0, 5), ("l3", "nobody", 10.0, 5), ("l4", None, 10.0, 5), ("l5", "b1", 1.0, 1)],
        "loan_id string, borrower_id string, emi_amount double, tenure int",
    )
    people = spark.createDataFrame(
        [("b1", 100.0, 700), ("b2", 0.0, 600), (None, 50.0, 500)], "borrower_id string, income double, credit_score int"
    )
    return repay, loans, people


@pytest.mark.parametrize("hot", [1, 10**9])
def test_loan_features(spark, hot):
    got = {r["loan_id"]: r for r in loan_features(*_loans(spark), min_hot_rows=hot).collect()}
    assert set(got) == {"l1", "l2", "l3", "l4"}
    assert {k: r["default_flag"] for k, r in got.items()} == {"l1": 1, "l2": 0, "l3": 0, "l4": 0}
    assert got["l1"]["emi_income_ratio"] == 0.1
    assert got["l2"]["emi_income_ratio"] is None  # no income
    assert got["l3"]["income"] is None  # unknown borrower
    assert got["l4"]["income"] == 50.0  # missing id meets missing id


def test_overlapping_names_get_suffixes(spark):
    repay, loans, people = _loans(spark)
    loans = loans.withColumn("note", F.lit("loan")).withColumn("total_payments", F.lit(1))
    people = people.withColumn("note", F.lit("person"))
    row = loan_features(repay, loans, people).where("loan_id = 'l1'").first()
    assert (row["note_x"], row["note_y"]) == ("loan", "person")
    assert (row["total_payments_x"], row["total_payments_y"]) == (1, 1)


def test_a_borrower_with_a_third_of_all_loans(spark):
    n = 3000
    repay = spark.range(n).select(F.col("id").alias("loan_id"), F.lit(1).alias("emi_number"), (F.col("id") % 120).alias("days_past_due"))
    loans = spark.range(n).select(
        F.col("id").alias("loan_id"),
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("borrower_id"),
        F.lit(1.0).alias("emi_amount"),
    )
    people = spark.range(n).select(F.when(F.col("id") == 0, -1).otherwise(F.col("id")).alias("borrower_id"), F.lit(2.0).alias("income"))
    even = loan_features(repay, loans, people, min_hot_rows=10**9)
    spread = loan_features(repay, loans, people, min_hot_rows=100)
    assert sorted(map(str, even.collect())) == sorted(map(str, spread.collect()))
    assert spread.count() == n


def test_features_need_one_exchange_per_input(spark, tmp_path):
    frames = []
    for name, df in zip(("r", "l", "p"), _loans(spark), strict=True):
        df.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = loan_features(*frames)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(loan_id") == 2
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_reports(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None)], "loan_id int, default_flag int")
    assert [(r[0], r[1]) for r in value_counts(df, "default_flag").collect()] == [(0, 2), (1, 1)]
    assert default_rate(df).first()[0] == pytest.approx(1 / 3)
    assert [r["loan_id"] for r in preview(df, ["loan_id"], 2).collect()] == [1, 2]


@pytest.mark.parametrize(
    ("score", "tier", "outcome"),
    [
        (900, "A - Low Risk", "Approve"), (750, "A - Low Risk", "Approve"),
        (749, "B - Medium Risk", "Approve with conditions"), (650, "B - Medium Risk", "Approve with conditions"),
        (649, "C - High Risk", "Manual review"), (550, "C - High Risk", "Manual review"),
        (549, "D - Very High Risk", "Reject"), (300, "D - Very High Risk", "Reject"), (None, None, None),
    ],
)
def test_tiers(spark, score, tier, outcome):
    df = spark.createDataFrame([(score,)], "s int").select(risk_tier(F.col("s")).alias("t"))
    assert df.select("t", decision(F.col("t"))).first()[:] == (tier, outcome)


def test_scores_are_cut(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (0.2501,), (None,)], "p double")
    assert [r[0] for r in df.select(risk_score(F.col("p"))).collect()] == [900, 300, 600, 749, None]
    z = spark.createDataFrame([(2.0,)], "x double").select(logistic({"x": 0.5}, -1.0)).first()[0]
    assert z == 0.5


def test_correlations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    data = [(float(a), float(-a), 1.0, float(a + b) if i % 4 else None) for i, (a, b) in enumerate(zip(x, rng.normal(size=300), strict=True))]
    df = spark.createDataFrame(data, "x double, neg double, const double, gap double")
    m = {(r[0], r[1]): r[2] for r in correlation_matrix(df, df.columns).collect()}
    assert len(m) == 16
    assert m[("x", "neg")] == pytest.approx(-1) and m[("x", "x")] == pytest.approx(1)
    assert m[("x", "const")] is None and m[("const", "const")] is None
    kept = [(d[0], d[3]) for d in data if d[3] is not None]
    assert m[("gap", "x")] == m[("x", "gap")] == pytest.approx(np.corrcoef(np.array(kept).T)[0, 1])
    ranked = label_correlations(df, ["neg", "const", "gap"], "x").collect()
    assert [r["feature"] for r in ranked] == ["x", "gap", "neg", "const"]
    top = risk_drivers(label_correlations(df, ["neg", "const", "gap"], "x"), "x")
    assert [(r["driver"], r["feature"]) for r in top.collect()] == [
        ("risk", "gap"), ("risk", "neg"), ("protective", "neg"), ("protective", "gap")
    ]
    said = {r["feature"]: r["narration"] for r in narrate(top).collect()}
    assert said["neg"] == "Higher neg decreases default risk (correlation -1.0)"
    assert said["gap"].startswith("Higher gap increases default risk (correlation 0.")


def test_correlations_of_hard_columns(spark):
    """Constants in several tasks, values far from zero, columns that never meet, NaN, and no rows."""
    rng = np.random.default_rng(3)
    n = 4000
    far = 1e9 + rng.normal(size=n)
    other = far + rng.normal(size=n)
    data = [
        (0.1, float(f), float(o), float(f) if i % 2 else None, None if i % 2 else float(o), float("nan") if i % 3 else float(o))
        for i, (f, o) in enumerate(zip(far, other, strict=True))
    ]
    columns = ["const", "far", "other", "odd", "even", "third"]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in columns)).repartition(7)
    m = {(r[0], r[1]): r[2] for r in correlation_matrix(df, columns).collect()}
    assert m[("far", "other")] == pytest.approx(np.corrcoef(far, other)[0, 1], abs=1e-6)
    assert m[("far", "third")] == pytest.approx(np.corrcoef(far[::3], other[::3])[0, 1], abs=1e-6)
    assert all(m[("const", c)] is None for c in columns if c != "odd" and c != "even")
    assert ("odd", "even") not in m or m[("odd", "even")] is None
    assert correlation_matrix(df.limit(0), columns).collect() == []


def _toy(spark, n=600):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 2)) * [1.0, 3.0]
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.4 * x[:, 1] + 0.3)))).astype(int)
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    return x, y, spark.createDataFrame(rows, "loan_id int, a double, b double, default_flag int")


def test_fit_reaches_the_regularised_optimum(spark):
    x, y, df = _toy(spark)
    model = fit(df, ["a", "b"])
    w = np.zeros(3)
    design = np.c_[x, np.ones(len(x))]
    ridge = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + ridge @ w
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, gradient)
    assert list(model.coefficients.values()) == pytest.approx(list(w[:2]), abs=1e-4)
    assert model.intercept == pytest.approx(w[2], abs=1e-4)
    scored = model.predict(df)
    given = df.select("loan_id", logistic(model.coefficients, model.intercept).alias("p"))
    gap = scored.join(given, "loan_id").agg(F.max(F.abs(F.col("p") - F.col("default_probability")))).first()[0]
    assert gap < 1e-9


def test_quality_counts_ties_half(spark):
    df = spark.createDataFrame(
        [(0.1, 0.0, 0), (0.4, 0.0, 1), (0.4, 0.0, 0), (0.8, 1.0, 1)], "default_probability double, prediction double, default_flag int"
    )
    assert prediction_quality(df) == pytest.approx((0.75, 0.875))


@pytest.mark.parametrize("labels, area", [([], None), ([0, 0], None), ([1, 1], float("nan"))])
def test_quality_without_both_labels(spark, labels, area):
    rows = [(0.1 * (i + 1), 0.0, y) for i, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "default_probability double, prediction double, default_flag int")
    accuracy = sum(1 - y for y in labels) / len(labels) if labels else None
    assert prediction_quality(df) == (accuracy, area if area is None else pytest.approx(area, nan_ok=True))


def test_assessment(spark):
    _, _, df = _toy(spark)
    result = assess(df, ["a", "b"])
    assert 0.5 < result.accuracy <= 1 and 0.5 < result.area_under_roc <= 1
    assert result.scored.count() == 600
    assert {"risk_score", "risk_tier", "decision", "split", "prediction"} <= set(result.scored.columns)
    shares = {r["split"]: r["count"] for r in with_split(df).groupBy("split").count().collect()}
    assert 80 < shares["test"] < 160


def test_incomplete_rows(spark):
    _, _, df = _toy(spark, 40)
    gaps = df.withColumn("a", F.when(F.col("loan_id") % 4 != 0, F.col("a")))
    assert incomplete_rows(gaps, ["a", "b"]).first()[:] == (10, 40)
    with pytest.raises(Exception, match="(?i)null"):
        fit(gaps, ["a", "b"])
    skipped = fit(gaps, ["a", "b"], handle_invalid="skip")
    assert skipped.predict(gaps).count() == 30


def test_loan_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("days_past_due,loan_id,other,emi_number\n3,L1,x,1\nNaN,L1,x,2\nNA,,x,3.0\n1.5,L2,x,z\n")
    got = [r[:] for r in read_repayments(spark, str(tmp_path / "r.csv")).collect()]
    assert got == [("L1", 1, 3.0), ("L1", 2, None), (None, 3, None), ("L2", None, 1.5)]
    (tmp_path / "l.csv").write_text("loan_id,borrower_id,loan_amount,tenure,emi_amount\nL1,B1,100,12,10.5\n")
    assert read_loans(spark, str(tmp_path / "l.csv")).first()[:] == ("L1", "B1", 100.0, 12, 10.5)
    (tmp_path / "b.csv").write_text("borrower_id,income,credit_score\nB1,null,700\n")
    assert read_borrowers(spark, str(tmp_path / "b.csv")).first()[:] == ("B1", None, 700)


@pytest.fixture(scope="module")
def gappy(tmp_path_factory):
    """The smallest tables, with borrowers who are unknown or have no income."""
    folder = tmp_path_factory.mktemp("gappy")
    for table in Path("/root/testdata/sf0.001").glob("*.parquet"):
        (folder / table.name).symlink_to(table)
    (folder / "customer.parquet").unlink()
    rows = "select * replace (case when c_custkey % 9 = 2 then 0 else c_acctbal end as c_acctbal)"
    duckdb.sql(
        f"copy ({rows} from '/root/testdata/sf0.001/customer.parquet' where c_custkey % 16 <> 5) to '{folder}/customer.parquet' (format parquet)"
    )
    return str(folder)


@pytest.mark.parametrize("name", ["loan_assessment", "loan_fit", "loan_model", "score_quality", "loan_scores", "tier_counts"])
def test_loans_that_lack_a_feature(spark, gappy, name):
    assert difference(all_queries()[name](spark, gappy), all_oracles()[name], connect(gappy)) is None


@pytest.fixture(scope="module", params=["no test loans", "all defaulted"])
def one_sided(request, tmp_path_factory):
    """The smallest tables, with training loans only or with repayments that are all late by 105 days."""
    folder = tmp_path_factory.mktemp("one-sided")
    for table in Path("/root/testdata/sf0.001").glob("*.parquet"):
        (folder / table.name).symlink_to(table)
    name, rows = {
        "no test loans": ("orders", "select * from {} where ('0x' || md5(o_orderkey || '|42')[:8])::bigint % 10 >= 2"),
        "all defaulted": ("lineitem", "select * replace (50.0::double as l_quantity) from {}"),
    }[request.param]
    (folder / f"{name}.parquet").unlink()
    rows = rows.format(f"'/root/testdata/sf0.001/{name}.parquet'")
    duckdb.sql(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["score_quality", "loan_assessment"])
def test_quality_of_one_sided_loans(spark, one_sided, name):
    got = all_queries()[name](spark, one_sided)
    cursor = connect(one_sided).execute(all_oracles()[name])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    have = sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)
    assert str(have) == str(want)  # as text, because NaN is not itself


def test_rows_that_lack_a_feature_are_kept(spark):
    _, _, df = _toy(spark)
    gaps = df.withColumn("a", F.when(F.col("loan_id") % 4 == 1, float("nan")).when(F.col("loan_id") % 4 != 0, F.col("a")))
    model = fit(gaps, ["a", "b"], handle_invalid="keep")
    assert model.coefficients == pytest.approx(fit(gaps, ["a", "b"], handle_invalid="skip").coefficients)
    scored = model.predict(gaps)
    assert (scored.count(), scored.where("default_probability is null and prediction is null").count()) == (600, 300)
