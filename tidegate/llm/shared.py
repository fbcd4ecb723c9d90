"""Helpers that the operators share: reading, written intermediate tables, per-text Arrow maps."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidegate.plans.workspace import new_folder

#: Rows that a Python worker turns into Python objects at once.
ROWS_AT_ONCE = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, safe from lost executors."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    start: Callable[[], Callable[[str | None], tuple]],
    schema: str,
) -> DataFrame:
    """``keep`` columns as struct ``row`` and, beside it, what a function makes of each text.

    ``start`` runs once in each task and returns the function, so models and tables are loaded
    there.  The function gets a whole text (or None) and returns a value for each column of
    ``schema``.  A few rows at a time are Python objects, whatever the Arrow batch holds.
    """
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    results = StructType.fromDDL(schema)
    out = StructType([source.schema["row"], *results.fields])
    arrow = to_arrow_schema(results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                made = [each(x) for x in part.column(1).to_pylist()]
                columns = [pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["row", *arrow.names])

    return source.mapInArrow(run, out)


def explode_batches(
    df: DataFrame,
    start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: str | StructType,
) -> DataFrame:
    """A mapInArrow whose function sees a few rows at a time and may return any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = each(batch.slice(at, ROWS_AT_ONCE))
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def once_per_worker(name: str, version: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in the Python worker for its next tasks; another version replaces it.

    Functions travel to the workers by value, so their own module does not last there; a module made
    for the purpose does.  Tokenizers of one library keep memory of each of their threads for good when
    they are loaded again and again, so they are loaded once and use the task's own thread.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = sys.modules.setdefault("tidegate_worker", types.ModuleType("tidegate_worker")).__dict__
    if name not in kept or kept[name][0] != version:
        kept[name] = (version, make())
    return kept[name][1]


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def share_of(key: Column, rows: int, bound: int) -> Column:
    """True for a share of the keys, by hash, so that about ``bound`` of ``rows`` rows remain."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int((1 << 30) * bound / rows))


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join whose left side may have hot keys and whose right side comes from an aggregation by them.

    The right side would bring its partitioning along, and Spark splits skewed partitions only where
    both sides are dealt out for the join itself.  A second key, a hash of the first, makes it so.
    """
    mixed = F.xxhash64(F.lit(7), *keys)
    joined = left.withColumn("mixed_", mixed).join(right.withColumn("mixed_", mixed), [*keys, "mixed_"], how)
    return joined.drop("mixed_")
