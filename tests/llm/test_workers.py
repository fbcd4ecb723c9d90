"""All queries with Python workers that cannot import this repository."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from brute import SF

ROOT = Path(__file__).resolve().parents[2]

CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's path alone: workers start from their own folder
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
    "spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()

def probe(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        found = importlib.util.find_spec("tidegate") is not None
        yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])

assert not any(r.found for r in spark.range(8).mapInArrow(probe, "found boolean").collect())
import __spark_entry__ as entry
from tidegate.llm.queries import llm_queries
for name in [*llm_queries(), "pipeline", "loan_model", "correlation_matrix", "file_rows"]:
    entry.queries()[name](spark, {sf!r}).write.parquet({out!r} + "/" + name)
    assert spark.read.parquet({out!r} + "/" + name).count() > 0, name
print("all written")
"""


def test_workers_without_the_repository(tmp_path):
    code = CODE.format(root=str(ROOT), sf=SF, out=str(tmp_path / "out"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=False)
    assert done.returncode == 0 and "all written" in done.stdout, done.stderr[-3000:]
