from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidegate.contract import HARD, Contract
from tidegate.functions import checks as C
from tidegate.plans.ingest import (
    FAILED,
    PARTIAL,
    SUCCESS,
    Options,
    Reference,
    ingest_deliveries,
    ingest_delivery,
    ingest_files,
    ingest_frames,
)
from tidegate.sinks.zones import Zones, add_table_date, declare_table, write_date, write_manifests
from tidegate.sources.files import file_facts
from tidegate.sources.landing import list_files, read_header, read_landing
from tidegate.sources.zones import exists, latest_date, read_partition, read_zone

CONTRACT = Contract.define(
    "people",
    mandatory="id BIGINT, department STRING",
    optional="score DOUBLE, mail STRING",
    rules=[C.regex_match("mail", "@", HARD), C.positive_number("score")],
)
HEADER = "id,department,score,mail"
DAY = "2024-01-15"


def write(path, *lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def run(spark, tmp_path, *lines, day=DAY, header=HEADER, name="people.csv", **options):
    file = write(tmp_path / "landing" / name, *lines, header=header)
    zones = Zones(str(tmp_path / "lake"), "people")
    return zones, ingest_files(spark, file, CONTRACT, zones, day, options=Options(**options))


def reasons(spark, zones, day=DAY):
    return sorted(r["rejection_reason"] for r in read_partition(spark, zones.quarantine, day).collect())


def test_corrupt_rows_are_counted_not_padded(spark, tmp_path):
    zones, result = run(
        spark, tmp_path,
        "1,HR,1.5,a@b", "2,HR,1.5", "3,HR,1.5,a@b,x", '4,"HR,1.5,a@b', '5,"H', 'R",1.5,a@b', '6,"H, R",1.5,a@b',
    )
    valid = {r["id"]: r["department"] for r in read_partition(spark, zones.valid, DAY).collect()}
    assert valid == {1: "HR", 6: "H, R"}
    assert reasons(spark, zones) == ["CORRUPT_CSV_ROW"] * 5
    assert (result.read, result.schema_rejected, result.valid, result.status) == (7, 5, 2, PARTIAL)
    raw = {r["raw_record"] for r in read_partition(spark, zones.quarantine, DAY).collect()}
    assert "2,HR,1.5" in raw and "3,HR,1.5,a@b,x" in raw


def test_both_layers_share_one_quarantine(spark, tmp_path):
    zones, result = run(
        spark, tmp_path, "1,HR,1.5,a@b", "x,HR,1.5,a@b", "2,NA,1.5,a@b", "3,HR,1.5,ab", "4,HR,-1,a@b", soft_fail_threshold=0.3
    )
    assert reasons(spark, zones) == ["NULL_MANDATORY:department", "NULL_MANDATORY:id", "mail__regex"]
    assert (result.read, result.schema_rejected, result.dq_failed, result.valid, result.warned) == (5, 2, 1, 2, 1)
    assert result.read == result.quarantined + result.valid and result.breach
    rows = {r["id"]: r for r in read_partition(spark, zones.valid, DAY).collect()}
    assert (rows[4]["dq_status"], rows[4]["dq_failed_checks"], rows[1]["dq_status"]) == ("WARN", "score__positive", "PASS")
    assert rows[1]["_dt"] == DAY and rows[1]["_source_dataset"] == "people" and len(rows[1]["_row_md5"]) == 32
    refused = read_partition(spark, zones.quarantine, DAY).where("rejection_reason = 'mail__regex'").first()
    assert refused["rejection_layer"] == "DQ_CHECK" and refused["source_file"].endswith("people.csv")
    assert json.loads(refused["raw_record"])["mail"] == "ab"
    summary = spark.read.json(zones.summary)
    assert summary.agg(F.sum("rows")).first()[0] == 3
    assert spark.read.json(zones.audit).first()["status"] == PARTIAL


def test_rerun_leaves_nothing_behind(spark, tmp_path):
    zones, _ = run(spark, tmp_path, "1,HR,1.5,a@b", "x,HR,1,a@b", "3,HR,1,ab")
    zones, result = run(spark, tmp_path, "1,HR,1.5,a@b", "2,HR,1,a@b")
    assert result.status == SUCCESS and reasons(spark, zones) == []
    zones, result = run(spark, tmp_path)
    assert result.read == 0 and read_partition(spark, zones.valid, DAY).count() == 0


def test_keep_and_rescan_agree(spark, tmp_path):
    lines = [f"{i if i % 7 else 'x'},{'HR' if i % 5 else 'NA'},{i - 20},{'a@b' if i % 3 else 'ab'}" for i in range(100)]
    kept = run(spark, tmp_path / "a", *lines)[1]
    again = run(spark, tmp_path / "b", *lines, keep=False)[1]
    for name in ("read", "schema_rejected", "dq_failed", "valid", "warned", "status"):
        assert getattr(kept, name) == getattr(again, name)
    assert kept.read == 100 == kept.quarantined + kept.valid


def test_escalation_refuses_soft_findings(spark, tmp_path):
    lines = ["1,HR,1.5,a@b", "2,HR,-1,a@b"]
    zones, result = run(spark, tmp_path, *lines, soft_fail_threshold=0.1, escalate=True)
    assert (result.valid, result.dq_failed, result.escalated, result.breach) == (1, 1, True, True)
    assert reasons(spark, zones) == ["score__positive"]
    _, result = run(spark, tmp_path, *lines, soft_fail_threshold=0.9, escalate=True)
    assert (result.valid, result.escalated) == (2, False)


def test_headers_are_mapped_by_name(spark, tmp_path):
    files = [
        write(tmp_path / "l" / "1.csv", "1,HR,1.5,a@b"),
        write(tmp_path / "l" / "2.csv", "a@b,2.5,2,IT", header="mail,score,id,department"),
        write(tmp_path / "l" / "3.csv", "3,Risk,x", header="id,department,nick"),
        write(tmp_path / "l" / "4.csv", "4,1.5", header="id,score"),
    ]
    assert read_header(spark, files[1]) == ["mail", "score", "id", "department"]
    assert len(list_files(spark, str(tmp_path / "l"))) == 4 and len(read_landing(spark, files)) == 4
    zones = Zones(str(tmp_path / "lake"), "people")
    result = ingest_files(spark, files, CONTRACT, zones, DAY)
    rows = {r["id"]: r for r in read_partition(spark, zones.valid, DAY).collect()}
    assert {k: r["department"] for k, r in rows.items()} == {1: "HR", 2: "IT", 3: "Risk"}
    assert (rows[2]["score"], rows[3]["nick"], rows[1]["nick"], rows[3]["mail"]) == (2.5, "x", None, None)
    assert reasons(spark, zones) == ["MISSING_MANDATORY_COLUMNS:department"]
    assert result.status == PARTIAL and result.errors == ["MISSING_MANDATORY_COLUMNS:department"]


def test_uniform_header_refuses_a_deviating_file(spark, tmp_path):
    files = [
        write(tmp_path / "l" / "1.csv", "1,HR,1.5,a@b"),
        write(tmp_path / "l" / "2.csv", "HR,2,1.5,a@b", header="department,id,score,mail"),
    ]
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, files, uniform_header=True)[0].collect()


def test_missing_mandatory_column_fails_the_run_and_keeps_the_rows(spark, tmp_path):
    zones, result = run(spark, tmp_path, "1,1.5", "2,2.5", header="id,score")
    assert (result.status, result.read, result.valid) == (FAILED, 2, 0)
    assert reasons(spark, zones) == ["MISSING_MANDATORY_COLUMNS:department"] * 2


def test_reserved_names_refuse_the_batch(spark, tmp_path):
    zones, result = run(spark, tmp_path, "1,HR,PASS,x", header="id,department,dq_status,_row_md5")
    assert result.status == FAILED and reasons(spark, zones) == ["AMBIGUOUS_COLUMNS:_row_md5,dq_status"]


def test_repeated_header_names(spark, tmp_path):
    zones, result = run(spark, tmp_path, "1,HR,a,b", header="id,department,x,x")
    assert result.valid == 1


def test_incompatible_schema_goes_to_quarantine(spark, tmp_path):
    zones, first = run(spark, tmp_path, "1,HR,1.5,a@b", day="2024-01-14")
    narrower = Contract.define("people", mandatory="id BIGINT, department STRING", optional="score BIGINT")
    file = write(tmp_path / "landing" / "n.csv", "1,HR,2", header="id,department,score")
    result = ingest_files(spark, file, narrower, zones, DAY)
    assert result.status == FAILED and result.valid == 0
    assert result.errors == ["INCOMPATIBLE_SCHEMA:TYPE_CHANGE:score,COLUMN_REMOVED:mail"]
    assert reasons(spark, zones) == result.errors
    # an additive column may come and go
    run(spark, tmp_path, "1,HR,1.5,a@b,z", day="2024-01-16", header=HEADER + ",extra")
    assert run(spark, tmp_path, "1,HR,1.5,a@b", day="2024-01-17")[1].status == SUCCESS


def test_keys_and_references(spark, tmp_path):
    parents = spark.createDataFrame([("HR",), ("IT",)], "name string")
    zones, result = run(
        spark, tmp_path, "1,HR,1,a@b", "1,IT,1,a@b", "2,XX,1,a@b", "x,HR,1,a@b",
        unique_keys=["id"], unique_severity=HARD,
        references=[Reference("department", parents, "name")],
    )
    assert (result.valid, result.dq_failed, result.schema_rejected, result.warned) == (1, 2, 1, 1)
    assert reasons(spark, zones) == ["NULL_MANDATORY:id", "id__unique", "id__unique"]
    row = read_partition(spark, zones.valid, DAY).first()
    assert row["dq_failed_checks"] == "department__exists" and "_is_repeated" not in row.asDict()


def test_bad_run_date(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, tmp_path, "1,HR,1,a@b", day="20240115x")


def test_hash_columns_and_partition_columns(spark, tmp_path):
    zones, _ = run(spark, tmp_path, "1,HR,1,a@b", "2,IT,1,a@b", hash_columns=["mail"], partition_columns=["department"])
    rows = read_partition(spark, zones.valid, DAY)
    assert rows.select("_row_md5").distinct().count() == 1
    assert (tmp_path / "lake/people/valid" / f"dt={DAY}" / "department=IT").is_dir()


def test_zones_read_like_partitioned_datasets(spark, tmp_path):
    zones, _ = run(spark, tmp_path, "1,HR,1,a@b", day="2024-01-14")
    run(spark, tmp_path, "2,HR,1,a@b,z", day=DAY, header=HEADER + ",extra")
    run(spark, tmp_path, "x,HR,1,a@b", day="2024-01-16")
    assert latest_date(spark, zones.valid, "dt") == "2024-01-16"
    assert latest_date(spark, zones.valid, "dt", before=DAY) == "2024-01-14"
    assert latest_date(spark, zones.valid + "x", "dt") is None
    merged = read_zone(spark, zones.valid, merge_schema=True)
    assert "extra" in merged.columns and merged.count() == 2
    one = read_zone(spark, zones.valid).where(F.col("dt") == F.lit(DAY).cast("date"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert spark.read.parquet(zones.quarantine).count() == 1


def test_catalog_table(spark, tmp_path):
    root = str(tmp_path / "t")
    write_date(spark.range(3), root, "2024-01-01")
    declare_table(spark, "zone_table_test", root, spark.range(1).schema)
    write_date(spark.range(5), root, "2024-01-02")
    add_table_date(spark, "zone_table_test", root, "2024-01-02")
    assert spark.table("zone_table_test").groupBy("dt").count().count() == 2
    spark.sql("drop table zone_table_test")


def test_delivery_is_verified_before_it_is_read(spark, tmp_path):
    landing = tmp_path / "landing"
    zones = Zones(str(tmp_path / "lake"), "people")
    assert ingest_delivery(spark, str(landing), CONTRACT, zones, DAY).errors == ["file_arrived: file not found"]
    file = landing / "people" / "people_20240115.csv"
    write(file, "1,HR,1,a@b", "2,HR,1,a@b")
    result = ingest_delivery(spark, str(landing), CONTRACT, zones, DAY)
    assert result.status == FAILED and result.errors == ["manifest_present: manifest not found"]
    fact = file_facts(spark, str(landing / "people"), file.name).first()
    claim = {"checksum": fact["checksum"], "expected_rows": 2, "file_size_bytes": file.stat().st_size}
    manifest = landing / "people" / "people_20240115_manifest.json"
    manifest.write_text(json.dumps({**claim, "expected_rows": 3}, indent=2))
    result = ingest_delivery(spark, str(landing), CONTRACT, zones, DAY)
    assert result.errors == ["row_count_match: expected=3, actual=2"]
    manifest.write_text(json.dumps(claim, indent=2))
    result = ingest_delivery(spark, str(landing), CONTRACT, zones, DAY)
    assert (result.status, result.valid) == (SUCCESS, 2)


def test_an_unreadable_delivery_stops_no_other(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    contracts = [Contract.define(n, mandatory="id BIGINT, department STRING") for n in ("one", "two")]
    for name in ("one", "two"):
        file = landing / name / f"{name}_20240115.csv"
        write(file, "1,HR", header="id,department")
        fact = file_facts(spark, str(landing / name), file.name).first()
        claim = {"checksum": fact["checksum"], "expected_rows": 1, "file_size_bytes": file.stat().st_size}
        (landing / name / f"{name}_20240115_manifest.json").write_text(json.dumps(claim))

    def facts(session, path, pattern):
        if "two" in str(path):
            raise OSError("broken read")
        return file_facts(session, path, pattern)

    monkeypatch.setattr("tidegate.plans.ingest.file_facts", facts)
    found = ingest_deliveries(spark, str(landing), contracts, str(tmp_path / "lake"), DAY)
    assert found["one"].errors == [] and found["one"].status == SUCCESS
    assert found["two"].errors == ["OSError: broken read"]


def test_several_deliveries_at_once(spark, tmp_path):
    landing = tmp_path / "landing"
    contracts = [Contract.define(n, mandatory="id BIGINT, department STRING") for n in ("one", "two", "three", "four")]
    for name, rows in (("one", 2), ("two", 3), ("three", 2)):
        file = landing / name / f"{name}_20240115.csv"
        write(file, "1,HR", "2,HR", header="id,department")
        fact = file_facts(spark, str(landing / name), file.name).first()
        claim = {"checksum": fact["checksum"], "expected_rows": rows, "file_size_bytes": file.stat().st_size}
        if name != "three":
            (landing / name / f"{name}_20240115_manifest.json").write_text(json.dumps(claim))
    found = ingest_deliveries(spark, str(landing), contracts, str(tmp_path / "lake"), DAY)
    assert {n: (r.status, r.errors) for n, r in found.items()} == {
        "one": (SUCCESS, []),
        "two": (FAILED, ["row_count_match: expected=3, actual=2"]),
        "three": (FAILED, ["manifest_present: manifest not found"]),
        "four": (FAILED, ["file_arrived: file not found"]),
    }
    assert read_partition(spark, Zones(str(tmp_path / "lake"), "one").valid, DAY).count() == 2


def test_a_failed_rerun_owns_its_date(spark, tmp_path):
    landing = tmp_path / "landing"
    zones = Zones(str(tmp_path / "lake"), "people")
    file = landing / "people" / "people_20240115.csv"
    write(file, "1,HR,1,a@b", "x,HR,1,a@b")
    fact = file_facts(spark, str(landing / "people"), file.name).first()
    claim = {"checksum": fact["checksum"], "expected_rows": 2, "file_size_bytes": file.stat().st_size}
    manifest = landing / "people" / "people_20240115_manifest.json"
    manifest.write_text(json.dumps(claim))
    assert ingest_delivery(spark, str(landing), CONTRACT, zones, DAY).valid == 1
    manifest.write_text("{broken")
    assert ingest_delivery(spark, str(landing), CONTRACT, zones, DAY).status == FAILED
    for root in (zones.valid, zones.quarantine, zones.summary):
        assert not exists(spark, f"{root}/dt={DAY}")
    assert spark.read.json(zones.audit).first()["status"] == FAILED
    manifest.write_text(json.dumps(claim))
    assert ingest_delivery(spark, str(landing), CONTRACT, zones, DAY).valid == 1


def test_a_failing_job_is_reported(spark, tmp_path):
    landing = tmp_path / "landing"
    zones = Zones(str(tmp_path / "lake"), "people")
    file = landing / "people" / "people_20240115.csv"
    write(file, "1,HR,1,a@b")
    fact = file_facts(spark, str(landing / "people"), file.name).first()
    claim = {"checksum": fact["checksum"], "expected_rows": 1, "file_size_bytes": file.stat().st_size}
    (landing / "people" / "people_20240115_manifest.json").write_text(json.dumps(claim))
    broken = Options(hash_columns=["no_such_column"])
    result = ingest_delivery(spark, str(landing), CONTRACT, zones, DAY, broken)
    assert result.status == FAILED and "no_such_column" in result.errors[0]
    assert spark.read.json(zones.audit).first()["status"] == FAILED


def test_scan_once(spark, tmp_path):
    """The annotated rows come from one scan and no shuffle."""
    from tidegate.plans.ingest import annotate_all

    file = write(tmp_path / "a.csv", "1,HR,1,a@b")
    plan = annotate_all(read_landing(spark, file), CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan and "Python" not in plan


def test_manifest_records(spark, tmp_path):
    write(tmp_path / "people_20240115.csv", "1,HR,1,a@b")
    facts = file_facts(spark, str(tmp_path))
    write_manifests(facts, str(tmp_path / "m"), "v1", DAY)
    row = spark.read.json(str(tmp_path / "m")).first()
    assert (row["dataset_name"], row["filename"], row["expected_rows"]) == ("people", "people_20240115.csv", 1)


def test_ingest_frames_takes_any_text_frame(spark, tmp_path):
    df = spark.createDataFrame([("1", "HR"), ("2", None)], "id string, department string")
    result = ingest_frames([df], CONTRACT, Zones(str(tmp_path), "people"), DAY, run_id="r1")
    assert (result.run_id, result.valid, result.schema_rejected) == ("r1", 1, 1)
