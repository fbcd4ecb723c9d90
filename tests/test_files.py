from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.operators.manifests import CHECKS, failures_per_file_check, verify_files
from tidegate.sources.landing import read_landing
from tidegate.sources.files import _folder, file_facts, read_manifests


def deliver(folder, name, text, manifest=None, **claims):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())
    if manifest is None:
        manifest = json.dumps(
            {
                "dataset_name": "d",
                "checksum": hashlib.md5(text.encode()).hexdigest(),
                "expected_rows": text.count("\n") - 1,
                "file_size_bytes": len(text.encode()),
                **claims,
            },
            indent=2,
        )
    if manifest:
        (folder / name.replace(".csv", "_manifest.json")).write_text(manifest)


def test_facts(spark, tmp_path):
    texts = {
        "a.csv": "h\n1\n2\n",
        "b.csv": "h\n1",
        "c.csv": 'h\n"x\ny"\n',
        "d.csv": "",
        "e.csv": "h\n" + "é,long line\n" * 5000,
        "f.csv": "h\r\n1\r\n",
        "g.csv": "\ufeffh\n1\n",
        "h.csv": "\ufeffh\n1",
        "i.csv": "\n\n",
        "j k+l%20.csv": "h\n\x00\n",
        "k.csv": "h\n" + "\n".join(str(i) * (i % 300) for i in range(30_000)),
    }
    for n, t in texts.items():
        (tmp_path / n).write_bytes(t.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    for piece in (4096, 1):
        got = {r["file_name"]: r for r in file_facts(spark, str(tmp_path), piece_bytes=piece).collect()}
        assert set(got) == set(texts)
        for n, t in texts.items():
            assert got[n]["checksum"] == hashlib.md5(t.encode()).hexdigest()
            assert got[n]["file_size_bytes"] == len(t.encode())
        assert {n: r["data_rows"] for n, r in got.items()} == {
            "a.csv": 2, "b.csv": 1, "c.csv": 2, "d.csv": -1, "e.csv": 5000, "f.csv": 1,
            "g.csv": 1, "h.csv": 1, "i.csv": 1, "j k+l%20.csv": 1, "k.csv": 30_000,
        }
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "raw").mkdir()
    raw = bytes(range(256)) * 40 + b"\n\xff\xfe"
    (tmp_path / "raw" / "x.csv").write_bytes(raw)
    assert file_facts(spark, str(tmp_path / "raw")).first()["checksum"] == hashlib.md5(raw).hexdigest()


def test_every_kind_of_delivery(spark, tmp_path):
    good = "h\n1\n2\n"
    deliver(tmp_path, "d_20240101.csv", good)
    deliver(tmp_path, "d_20240102.csv", good, checksum="0")
    deliver(tmp_path, "d_20240103.csv", good, expected_rows=3)
    deliver(tmp_path, "d_20240104.csv", good, file_size_bytes=1)
    deliver(tmp_path, "d_2024.csv", good)
    deliver(tmp_path, "d_20240105.csv", good, manifest="")
    deliver(tmp_path, "d_20240106.csv", good, manifest="{broken")
    deliver(tmp_path, "d_20240107.csv", good, manifest="{}")
    names = [f"d_2024010{i}.csv" for i in range(1, 9)] + ["d_2024.csv"]
    expected = spark.createDataFrame([("d", n) for n in names], "dataset_name string, file_name string")
    verified = verify_files(expected, file_facts(spark, str(tmp_path)), read_manifests(spark, str(tmp_path)))
    got = {r["file_name"]: r for r in verified.collect()}

    def failed(name):
        return [c for c in CHECKS if got[name][c] == "FAIL"]

    def unknown(name):
        return [c for c in CHECKS if got[name][c] is None]

    assert failed("d_20240101.csv") == [] and got["d_20240101.csv"]["passed"]
    assert failed("d_20240102.csv") == ["checksum_match"]
    assert failed("d_20240103.csv") == ["row_count_match"]
    assert got["d_20240103.csv"]["errors"] == ["row_count_match: expected=3, actual=2"]
    assert failed("d_20240104.csv") == ["file_size_match"]
    assert failed("d_2024.csv") == ["filename_pattern"] and unknown("d_2024.csv") == []
    assert failed("d_20240105.csv") == ["manifest_present"] and len(unknown("d_20240105.csv")) == 4
    assert failed("d_20240106.csv") == ["manifest_parseable"] and len(unknown("d_20240106.csv")) == 3
    assert failed("d_20240107.csv") == ["checksum_match", "row_count_match", "file_size_match"]
    assert failed("d_20240108.csv") == ["file_arrived"] and len(unknown("d_20240108.csv")) == 6
    assert sum(r["passed"] for r in got.values()) == 1
    counts = {(r["check_name"], r["outcome"]): r["files"] for r in failures_per_file_check(verified).collect()}
    assert counts[("file_arrived", "FAIL")] == 1 and counts[("checksum_match", "FAIL")] == 2


def test_files_that_only_spark_reaches(spark, tmp_path):
    folder = tmp_path / "in"
    deliver(folder, "d_20240101.csv", "h\n1\n2\n")
    deliver(folder, "d_20240102.csv", "h\n1\n2\n", checksum=hashlib.md5(b"h\n1\n3\n").hexdigest())
    deliver(folder, "d [x] {y}.csv", "h\n1\n2\n")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.mounted.link./in", folder.as_uri())
    there = "viewfs://mounted/in"
    facts = file_facts(spark, there)
    assert {r.file_name: r.checksum for r in facts.collect()} == {
        p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in folder.glob("*.csv")
    }
    expected = spark.createDataFrame([("d", f"d_2024010{i}.csv") for i in (1, 2)], "dataset_name string, file_name string")
    claims = read_manifests(spark, there)
    assert {r.file_name: r.passed for r in verify_files(expected, facts, claims).collect()} == {
        "d_20240101.csv": True, "d_20240102.csv": False
    }


def test_unhashed_files_do_not_pass(spark, tmp_path):
    deliver(tmp_path, "d_20240101.csv", "h\n1\n2\n")
    deliver(tmp_path, "d_20240102.csv", "h\n1\n2\n", checksum=None)
    expected = spark.createDataFrame([("d", f"d_2024010{i}.csv") for i in (1, 2)], "dataset_name string, file_name string")
    facts = file_facts(spark, str(tmp_path)).withColumn("checksum", F.lit(None).cast("string"))
    claims = read_manifests(spark, str(tmp_path))
    for allowed in (False, True):
        got = {r.file_name: r for r in verify_files(expected, facts, claims, allow_unhashed=allowed).collect()}
        assert got["d_20240101.csv"].checksum_match == "SKIPPED" and got["d_20240101.csv"].passed is allowed
        assert got["d_20240102.csv"].checksum_match == "FAIL" and not got["d_20240102.csv"].passed


def test_read_errors_are_not_passed_over(spark, tmp_path):
    names = ["file_path", "size", "start", "number", "lines", "content"]
    cut = pa.RecordBatch.from_arrays([pa.array([x]) for x in ("f.csv", 100, 0, 0, 1, b"short")], names=names)
    with pytest.raises(OSError, match="changed"):
        list(_folder()(iter([cut])))
    (tmp_path / "d_20240101.csv").write_text("h\n1\n")
    facts = file_facts(spark, str(tmp_path))
    (tmp_path / "d_20240101.csv").unlink()
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        facts.collect()


def test_headers_of_many_files_in_a_fixed_number_of_jobs(spark, tmp_path):
    def jobs(folder):
        group = f"headers-{folder.name}"
        spark.sparkContext.setJobGroup(group, group)
        frames = read_landing(spark, str(folder))
        spark.sparkContext._jsc.clearJobGroup()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), frames

    counts = []
    for files in (3, 60):
        folder = tmp_path / f"n{files}"
        folder.mkdir()
        for i in range(files):
            header = ("a,b", "b,a", '"a",c')[i % 3]
            (folder / f"{i} [x].csv").write_text(f"{header}\r\n{i},1\r\n")
        n, frames = jobs(folder)
        counts.append(n)
        assert sorted(tuple(f.columns[:2]) for f in frames) == [("a", "b"), ("a", "c"), ("b", "a")]
        assert sum(f.count() for f in frames) == files
    assert counts[0] == counts[1]
    one = tmp_path / "one"
    one.mkdir()
    for i in range(5):
        (one / f"{i}.csv").write_text(f"a,b\n{i},1\n")
    (one / "other.txt").write_text("not data\n")
    (frame,) = read_landing(spark, str(one))
    assert frame.count() == 5
    (one / "empty.csv").write_text("")
    assert [f.count() for f in read_landing(spark, str(one))] == [5]
    assert read_landing(spark, str(one / "empty.csv"))[0].columns == ["_corrupt_record", "_source_file"]
