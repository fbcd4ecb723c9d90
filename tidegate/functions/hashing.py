"""Row hashes and stable buckets, built from md5 so that any SQL engine can reproduce them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns whose names start like this carry run context, not content.
HASH_EXCLUDED_PREFIXES = (
    "_raw_", "_pipeline_", "_source_", "_dt", "dq_status", "dq_failed_checks", "validation_flag",
)


def content_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if not c.startswith(HASH_EXCLUDED_PREFIXES)]


def row_hash(columns: Iterable[str]) -> Column:
    """md5 over the ``|``-joined text of ``columns``, NULL written as ``NULL``.

    NULL and the text ``NULL`` hash alike, and so do values that contain the separator; use it
    to spot repeated deliveries, not as a key.
    """
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in columns]
    return F.md5(F.concat_ws("|", *texts))


def hash_number(*parts: Column) -> Column:
    """A 32-bit number as ``bigint`` from the md5 of the ``|``-joined parts."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, seed: int, buckets: int = 10) -> Column:
    """Stable bucket 0 … ``buckets`` - 1 of a key; independent of partitioning and of reruns."""
    return F.pmod(hash_number(key, F.lit(seed)), F.lit(buckets)).cast("int")
