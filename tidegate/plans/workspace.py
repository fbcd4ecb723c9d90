"""Where intermediate tables and streaming checkpoints live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared location the session names in ``spark.checkpoint.dir``.

    Every executor must see it.  A temporary folder is used only when the setting is absent and
    Spark runs in this one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidegate-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
