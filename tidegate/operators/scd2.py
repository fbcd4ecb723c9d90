"""Slowly changing dimension, type 2: merge one snapshot into the versions kept so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.hashing import row_hash

VERSION_COLUMNS = ("effective_from", "effective_to", "is_current", "version_hash")


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def open_versions(snapshot: DataFrame, tracked: Sequence[str], run_date: str) -> DataFrame:
    """A snapshot as versions that start on ``run_date``: also the first load of a dimension."""
    return snapshot.select(
        "*",
        _day(run_date).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        row_hash(tracked).alias("version_hash"),
    )


def as_of(dimension: DataFrame, run_date: str) -> DataFrame:
    """Versions in force on ``run_date``."""
    day = _day(run_date)
    ends = F.col("effective_to")
    return dimension.where((F.col("effective_from") <= day) & (ends.isNull() | (ends > day)))


def undo_run(dimension: DataFrame, run_date: str) -> DataFrame:
    """The dimension as it was before a run on ``run_date``: versions opened on that day go,
    versions closed on that day are open again."""
    day = _day(run_date)
    reopened = F.col("effective_to").eqNullSafe(day)
    restored = {
        "effective_to": F.when(~reopened, F.col("effective_to")),
        "is_current": F.col("is_current") | reopened,
    }
    return dimension.where(F.col("effective_from") != day).withColumns(restored)


def merge_current(
    current: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: str,
    close_missing: bool = False,
    one_per_key: bool = False,
) -> DataFrame:
    """Versions that come out of the open ones and a snapshot.

    One full outer join on the key, null-safe; per key it yields the kept, the closed, or the
    closed and the new version.  Columns are matched by name: one that only the snapshot has is NULL
    in older versions, one that only the open versions have is NULL in new ones.  Of several rows of
    a key in the snapshot the one with the smallest row hash counts; ``one_per_key`` says that there
    is only one, which saves a shuffle.
    """
    content = [c for c in current.columns if c not in VERSION_COLUMNS]
    content += [c for c in snapshot.columns if c not in content]
    columns = [*content, *VERSION_COLUMNS]
    day = _day(run_date)
    given = snapshot.columns

    def filled(df: DataFrame, other: DataFrame) -> list[Column]:
        return [F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns]

    # Rows of a key meet as structs, which compare NULLs as equal; the join keeps their partitioning.
    key = F.struct(*keys).alias("_new_key")
    if one_per_key:
        one = snapshot.select(key, "*")
    else:
        one = snapshot.groupBy(key).agg(F.min_by(F.struct(*given), row_hash(given)).alias("_row")).select("_new_key", "_row.*")
    fresh = open_versions(one, tracked, run_date)
    old = current.select(F.struct(*keys).alias("_old_key"), F.struct(*filled(current, fresh)).alias("_old"))
    new = fresh.select("_new_key", F.struct(*filled(fresh, current)).alias("_new"))
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = has_old & has_new & (F.col("_old.version_hash") != F.col("_new.version_hash"))
    gone = has_old & ~has_new & F.lit(close_missing)
    closed = (
        F.col("_old").withField("effective_to", day).withField("is_current", F.lit(False))
    )
    first = F.when(changed | gone, closed).when(has_old, F.col("_old"))
    second = F.when(has_new & (~has_old | changed), F.col("_new"))
    return pairs.select(F.inline(F.array_compact(F.array(first, second)))).select(*columns)


def merge(
    dimension: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: str,
    close_missing: bool = False,
) -> DataFrame:
    """The whole dimension after taking in ``snapshot``.

    Closed history passes by the join untouched.  Running the same day again gives the same
    result, because what that day did is undone first.
    """
    before = undo_run(dimension, run_date)
    history = before.where(~F.col("is_current"))
    current = before.where(F.col("is_current"))
    merged = merge_current(current, snapshot, keys, tracked, run_date, close_missing)
    return merged.unionByName(history, allowMissingColumns=True)


def backfill(
    dimension: DataFrame,
    snapshot: DataFrame,
    following: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: str,
    next_date: str,
) -> DataFrame:
    """The whole dimension after taking in the snapshot of a date before its last one.

    ``next_date`` is the first date after ``run_date`` that the dimension has taken in, ``following`` its
    snapshot.  Snapshots are complete: a key that one lacks is gone on that date, as with
    ``close_missing``.  The result is that of the dates in their order: the version in force on
    ``run_date`` ends there where the snapshot says otherwise, the snapshot holds until ``next_date``,
    and what was in force then starts then, or goes on where it is equal.  Of several rows of a key in a
    snapshot the one with the smallest row hash counts.  Only versions that touch the time between the
    two dates meet the snapshots in the join; all others pass by.
    """
    day, until = _day(run_date), _day(next_date)
    start, end = F.col("effective_from"), F.col("effective_to")
    near = (start <= until) & (end.isNull() | (end > day))
    columns = dimension.columns
    spans = (start < until) & (end.isNull() | (end > until))

    def rows_of(df: DataFrame, name: str) -> DataFrame:
        one = df.groupBy(F.struct(*keys).alias("_key")).agg(F.min_by(F.struct(*df.columns), row_hash(df.columns)).alias("_row"))
        opened = open_versions(one.select("_key", "_row.*"), tracked, run_date)
        return opened.select("_key", F.struct(*columns).alias(name))

    # Before the later date at most one version of a key, on it at most one more.
    sides = dimension.where(near).select(F.struct(*keys).alias("_key"), (start < until).alias("_before"), spans.alias("_spans"), F.struct(*columns).alias("_v"))
    met = sides.groupBy("_key").agg(
        F.min_by("_v", F.when(F.col("_before"), 1)).alias("_old"),
        F.min_by("_v", F.when(~F.col("_before"), 1)).alias("_then"),
        F.bool_or("_spans").alias("_spans"),
    )
    joined = met.join(rows_of(snapshot, "_new"), "_key", "full_outer").join(rows_of(following, "_next"), "_key", "left")
    old, then, new = F.col("_old"), F.col("_then"), F.col("_new")
    same = old.isNotNull() & new.isNotNull() & (old["version_hash"] == new["version_hash"])
    untouched = same | (old.isNull() & new.isNull())

    def dated(version: Column, first: Column, last: Column) -> Column:
        ended = version.withField("effective_from", first).withField("effective_to", last)
        return ended.withField("is_current", last.isNull())

    # What is in force on the later date; of a version that went on over it, the row delivered then.
    went_on = F.coalesce(F.col("_spans"), F.lit(False))
    tail = F.when(went_on, dated(F.coalesce("_next", old), until, old["effective_to"])).otherwise(then)
    goes_on = new.isNotNull() & tail.isNotNull() & (tail["version_hash"] == new["version_hash"])
    kept = [old, then]
    changed = [
        F.when(old.isNotNull(), dated(old, old["effective_from"], day)),
        F.when(goes_on, dated(new, day, tail["effective_to"])).when(new.isNotNull(), dated(new, day, until)),
        F.when(~goes_on, tail),
    ]
    versions = F.when(untouched, F.array(*kept)).otherwise(F.array(*changed))
    touched = joined.select(F.inline(F.array_compact(versions))).select(*columns)
    return dimension.where(~F.coalesce(near, F.lit(False))).unionByName(touched)
