from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog import EMPLOYEE_MASTER, PAYROLL_TRANSACTIONS
from tidegate.contract import Contract
from tidegate.functions import checks as C
from tidegate.plans import ingest
from tidegate.plans.ingest import Options, annotate, ingest_files
from tidegate.plans.workspace import new_folder
from tidegate.sinks.zones import Zones
from tidegate.sources.synthetic import PAYROLL_COLUMNS, employees, payroll
from tidegate.sources.zones import read_partition
from tidegate.streaming import landing
from tidegate.streaming.landing import start_ingest

DAY = "2024-01-15"
CONTRACT = Contract.define(
    "people", mandatory="id BIGINT, department STRING", optional="score DOUBLE", rules=[C.positive_number("score")]
)


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    text = "id,department,score\n" + "".join(f"{i if i % 5 else 'x'},{'HR' if i % 3 else 'NA'},{i - 4}\n" for i in range(60))
    (landing / "1.csv").write_text(text + "7,HR\n")
    stream, batch = Zones(str(tmp_path / "s"), "people"), Zones(str(tmp_path / "b"), "people")

    def take():
        start_ingest(spark, str(landing), CONTRACT, stream, DAY, str(tmp_path / "check")).awaitTermination()

    def content(zones, root, columns):
        return sorted(map(str, read_partition(spark, root, DAY).select(*columns).collect()))

    take()
    ingest_files(spark, str(landing / "1.csv"), CONTRACT, batch, DAY)
    columns = ["id", "department", "score", "dq_status"]
    assert content(stream, stream.valid, columns) == content(batch, batch.valid, columns)
    refused = ["rejection_reason", "raw_record"]
    assert content(stream, stream.quarantine, refused) == content(batch, batch.quarantine, refused)
    before = read_partition(spark, stream.valid, DAY).count()
    take()
    assert read_partition(spark, stream.valid, DAY).count() == before
    (landing / "2.csv").write_text("id,department,score\n100,HR,1\n")
    take()
    assert read_partition(spark, stream.valid, DAY).count() == before + 1


def test_unique_keys_hold_across_batches_and_runs(spark, tmp_path):
    landing, zones = tmp_path / "landing", Zones(str(tmp_path / "z"), "people")
    landing.mkdir()
    options = Options(unique_keys=["id"])

    def take(day=DAY, checkpoint="check", **files):
        for name, ids in files.items():
            (landing / f"{name}.csv").write_text("id,department,score\n" + "".join(f"{i},HR,1\n" for i in ids))
        start_ingest(spark, str(landing), CONTRACT, zones, day, str(tmp_path / checkpoint), None, options, files_at_once=1).awaitTermination()

    def found(day=DAY):
        rows = read_partition(spark, zones.valid, day).select("batch", "id", "dq_failed_checks").collect()
        return sorted((r.batch, r.id, r.dq_failed_checks == "id__unique") for r in rows)

    take(a=[1, 2, 3, 3])
    assert found() == [(0, 1, False), (0, 2, False), (0, 3, True), (0, 3, True)]
    take(b=[1, 4])
    take(c=[4, 5, "x", "NA"])
    later = [(i, r) for b, i, r in found() if b > 0]
    assert sorted(later) == [(1, True), (4, False), (4, True), (5, False)]
    # Batches that only clear the state write nothing; an empty run changes nothing.
    before = found()
    take()
    assert found() == before
    # Another date has its own keys, in the same state.
    take("2024-01-16", d=[1, 5, 6])
    assert [x[1:] for x in found("2024-01-16")] == [(1, False), (5, False), (6, False)]


def test_a_batch_with_unique_keys_is_judged_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,department,score\n1,HR,1\n1,HR,1\n")
    kept = []

    def write(annotated, *rest):
        kept.append(annotated.storageLevel.useMemory)
        return ingest.write_outcomes(annotated, *rest)

    monkeypatch.setattr(landing, "write_outcomes", write)
    zones = Zones(str(tmp_path / "z"), "people")
    options = Options(unique_keys=["id"])
    landing.start_ingest(spark, str(tmp_path / "in"), CONTRACT, zones, DAY, str(tmp_path / "check"), None, options).awaitTermination()
    assert kept == [True]


def test_a_replayed_batch_gives_the_same(spark, tmp_path):
    landing, zones = tmp_path / "landing", Zones(str(tmp_path / "z"), "people")
    landing.mkdir()
    (landing / "a.csv").write_text("id,department,score\n1,HR,1\n2,HR,1\n")
    args = (spark, str(landing), CONTRACT, zones, DAY, str(tmp_path / "check"), None, Options(unique_keys=["id"]))

    def found():
        rows = read_partition(spark, zones.valid, DAY).select("id", "dq_failed_checks").collect()
        return sorted((r.id, r.dq_failed_checks) for r in rows)

    start_ingest(*args).awaitTermination()
    (landing / "b.csv").write_text("id,department,score\n2,HR,1\n3,HR,1\n")
    start_ingest(*args).awaitTermination()
    once = found()
    assert once == [(1, ""), (2, ""), (2, "id__unique"), (3, "")]
    # As if the job had died before the last batches were committed.
    for n in (1, 2, 3):
        for f in (tmp_path / "check" / "commits").glob(f"*{n}*"):
            f.unlink()
    start_ingest(*args).awaitTermination()
    assert found() == once


def test_generated_rows_depend_on_the_id_only(spark):
    ids = spark.range(500)
    a = employees(ids.repartition(1), "2024-01-15 08:00:00")
    b = employees(ids.repartition(7), "2024-01-15 08:00:00")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    other = employees(ids, "2024-01-15 08:00:00", seed=1)
    assert sorted(map(str, a.collect())) != sorted(map(str, other.collect()))


def test_generation_is_spread_and_makes_only_what_is_asked_for(spark):
    people = employees(spark.range(0, 5_000, 1, 1), "2024-01-15 08:00:00")
    assert people.select(F.spark_partition_id()).distinct().count() > 1
    rows = people.select("id", "employee_id")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    assert sorted(rows.collect()) == sorted(r[:2] for r in people.select("id", "employee_id", "ssn").collect())


def test_generated_shares_and_contracts(spark):
    people = employees(spark.range(20_000), "2024-01-15 08:00:00").persist()
    assert people.columns == ["id", *EMPLOYEE_MASTER.names]
    out = annotate(people.drop("id"), EMPLOYEE_MASTER).persist()
    share = out.where("rejection_layer is not null").count() / 20_000
    assert abs(share - (1 - 0.97**4)) < 0.01
    assert out.where("dq_status in ('WARN', 'FAIL')").count() == 0
    assert out.where("rejection_reason like 'TYPE_CAST%'").count() == 0
    pay = payroll(people.select("id", "employee_id"), "2024-01-15 08:00:00")
    assert pay.columns == ["id", *PAYROLL_COLUMNS]
    paid = annotate(pay.drop("id"), PAYROLL_TRANSACTIONS).persist()
    share = paid.where("rejection_layer is not null").count() / 20_000
    assert abs(share - (1 - 0.975 * 0.95 * 0.95)) < 0.01
    full = paid.where("basic_salary is not null and hra is not null and special_allowance is not null "
                      "and conveyance_allowance is not null and medical_allowance is not null and gross_salary is not null")
    parts = F.expr("basic_salary + hra + special_allowance + conveyance_allowance + medical_allowance + incentive_amount + overtime_pay")
    assert full.where(F.abs(parts - F.col("gross_salary")) > 0.005).count() == 0
    for df in (people, out, paid):
        df.unpersist()


def test_folders_are_new_and_in_the_shared_place(spark):
    a, b = new_folder(spark, "x"), new_folder(spark, "x")
    assert a != b
    shared = spark.conf.get("spark.checkpoint.dir", "")
    assert not shared or a.startswith(shared)
