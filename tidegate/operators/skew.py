"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000
HOT_KEYS = 1_000
_TRACKED = 10_000
#: Tasks that share the rows of a key with just ``min_rows`` rows; more rows, more tasks.
_LEAST_SALTS = 4
KEY_ROWS = "key_rows"


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """The most frequent keys with their row counts: at most ``HOT_KEYS`` rows, whatever the input.

    A bounded frequency sketch per task names the candidates, a second pass over the key columns
    counts them; neither shuffles rows.  A key that is not listed has less than a share of
    1 / ``HOT_KEYS`` of all rows or fewer than ``min_rows``.  The list only steers where rows travel.
    """
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    sketch = hashed.agg(F.expr(f"approx_top_k(_h, {HOT_KEYS}, {_TRACKED})").alias("_top"))
    likely = (
        sketch.select(F.explode("_top").alias("_e"))
        .where(F.col("_e.count") >= min_rows)
        .select(F.col("_e.item").alias("_h"))
    )
    counted = hashed.join(F.broadcast(likely), "_h", "left_semi").groupBy(*keys)
    return counted.agg(F.count("*").alias(KEY_ROWS)).where(F.col(KEY_ROWS) >= min_rows)


def hot_values(df: DataFrame, columns: Sequence[str], min_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """For each of several single-column keys its most frequent values with their estimated counts.

    All columns share one pass, which runs here; at most ``HOT_KEYS`` values per column come back.
    """
    if not columns:
        return {}
    top = df.agg(*[F.expr(f"approx_top_k(`{c}`, {HOT_KEYS}, {_TRACKED})").alias(f"_top{i}") for i, c in enumerate(columns)])
    row = top.first()
    out = {}
    for i, c in enumerate(columns):
        listed = [(e["item"], e["count"]) for e in row[i] or () if e["item"] is not None and e["count"] >= min_rows]
        schema = T.StructType([T.StructField(c, df.schema[c].dataType), T.StructField(KEY_ROWS, T.LongType())])
        out[c] = df.sparkSession.createDataFrame(listed, schema)
    return out


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
    hot: DataFrame | None = None,
    spread: str | None = None,
    salts: int | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join on equally named ``keys``; rows of hot left keys are spread over several tasks.

    ``left`` is the side that may be skewed.  Its rows are spread by the numeric column
    ``spread``; without one they are numbered here, which needs a ``left`` that comes straight
    from a scan (narrow steps only), so that a row keeps its number when a lost task is run
    again.  ``right`` rows of hot keys are repeated once per salt; the number of salts follows from
    the key's row count (or is ``salts``).  ``hot`` (keys and ``key_rows``, at most ``HOT_KEYS``
    rows) is compared with both sides by value, as the join itself compares them, so the keys may
    be of unlike types.  Rows with a NULL key match nothing unless ``null_safe``; they are spread
    over all tasks.  ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.  The result has
    the left columns, then the right ones without the keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do {how!r}")
    keys = list(keys)
    if hot is None:
        complete = left if null_safe else left.dropna(subset=keys)
        hot = hot_keys(complete, keys, min_rows)
    tasks = F.ceil(F.col(KEY_ROWS) * _LEAST_SALTS / min_rows) if salts is None else F.lit(salts)
    # Bounded by construction: hot has at most HOT_KEYS rows.
    listed = F.broadcast(
        hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.greatest(tasks, F.lit(2)).cast("bigint").alias("_salts"))
    )

    def same(a: str, b: str) -> Column:
        pairs = [(F.col(a + k), F.col(b + k)) for k in keys]
        return reduce(lambda x, y: x & y, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])

    number = F.monotonically_increasing_id() if spread is None else F.col(spread)
    numbered = left.withColumn("_number", number)
    salt = F.coalesce(F.pmod("_number", "_salts"), F.lit(0))
    if not null_safe:
        incomplete = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
        salt = F.when(incomplete, F.col("_number")).otherwise(salt)
    hidden = ["_number", "_salts", *[f"_hot_{k}" for k in keys]]
    l = numbered.join(listed, same("", "_hot_"), "left").withColumn("_salt", salt.cast("bigint")).drop(*hidden)

    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_salts") - 1, F.lit(0).cast("bigint")))
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    r = renamed.join(listed, same("_right_", "_hot_"), "left").withColumn("_right_salt", F.explode(copies)).drop(*hidden)

    on = (F.col("_salt") == F.col("_right_salt")) & same("", "_right_")
    return l.join(r, on, how).drop("_salt", "_right_salt", *[f"_right_{k}" for k in keys])
