"""Row-level data quality: run checks, profile the outcome, find duplicates and orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.contract import HARD, SOFT
from tidegate.functions.checks import Check
from tidegate.operators.settle import settle
from tidegate.operators.skew import HOT_KEYS, HOT_ROWS, salted_join

DQ_LAYER = "DQ_CHECK"
DQ_COLUMNS = ("dq_status", "dq_failed_checks", "validation_flag")


def apply_checks(df: DataFrame, checks: Sequence[Check], where: Column | None = None) -> DataFrame:
    """Add ``dq_status`` (PASS/WARN/FAIL), ``dq_failed_checks`` (hard failures first, then soft,
    ``|``-joined) and ``validation_flag`` (0 iff FAIL).

    Each check is evaluated once per row, whatever their number.  Rows outside ``where`` are not
    checked and get NULLs.
    """

    def failures(severity: str) -> Column:
        return F.concat_ws("|", *[c.failure for c in checks if c.severity == severity])

    checked = F.lit(True) if where is None else where
    listed = df.select("*", failures(HARD).alias("_hard_failures"), failures(SOFT).alias("_soft_failures"))
    hard, soft = F.col("_hard_failures"), F.col("_soft_failures")
    any_hard, any_soft = F.length(hard) > 0, F.length(soft) > 0
    separator = F.when(any_hard & any_soft, "|").otherwise("")
    status = F.when(any_hard, "FAIL").when(any_soft, "WARN").otherwise("PASS")
    outcome = {
        "dq_status": F.when(checked, status),
        "dq_failed_checks": F.when(checked, F.concat(hard, separator, soft)),
        "validation_flag": F.when(checked, F.when(any_hard, 0).otherwise(1)),
    }
    return settle(listed, outcome).drop("_hard_failures", "_soft_failures")


def dq_valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("validation_flag") == 1)


def dq_failed(checked: DataFrame) -> DataFrame:
    """Rows with a hard failure; their failed checks become the rejection reason."""
    return (
        checked.where(F.col("validation_flag") == 0)
        .withColumnRenamed("dq_failed_checks", "rejection_reason")
        .withColumn("rejection_layer", F.lit(DQ_LAYER))
    )


def status_profile(checked: DataFrame, soft_fail_threshold: float | None = None) -> DataFrame:
    """One row: rows per status, the share of rows with a finding, and whether it exceeds the
    threshold."""
    status = F.col("dq_status")
    counts = checked.agg(
        F.count("*").alias("total"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARN").alias("warned"),
        F.count_if(status == "FAIL").alias("failed"),
    )
    share = F.try_divide(F.col("failed") + F.col("warned"), F.col("total"))
    if soft_fail_threshold is None:
        breach = F.lit(False)
    else:
        breach = F.coalesce(share > soft_fail_threshold, F.lit(False))
    return counts.select("*", share.alias("finding_share"), breach.alias("breach"))


def failures_per_check(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """How many rows fail each check: one aggregate over the input, no explode."""
    counted = df.agg(*[F.count_if(~c.passed).alias(c.name) for c in checks])
    rows = counted.unpivot([], [F.col(f"`{c.name}`") for c in checks], "check_name", "failed_rows")
    severity = F.create_map(*[F.lit(v) for c in checks for v in (c.name, c.severity)])
    return rows.select("check_name", severity[F.col("check_name")].alias("severity"), "failed_rows")


# -- checks that need other rows ------------------------------------------------------------


def repeated_keys(df: DataFrame, keys: Sequence[str], first_seen: DataFrame | None = None) -> DataFrame:
    """Keys that occur more than once, with their row counts.  Keys with a NULL part are not
    compared.  ``first_seen`` holds the keys that came with ``df`` for the first time: all others
    have been there before and are repeated as well."""
    complete = df
    for k in keys:
        complete = complete.where(F.col(k).isNotNull())
    counted = complete.groupBy(*keys).agg(F.count("*").alias("key_rows"))
    if first_seen is None:
        return counted.where(F.col("key_rows") > 1)
    new = first_seen.select(*keys, F.lit(True).alias("_is_new"))
    known = counted.join(new, list(keys), "left")
    return known.where((F.col("key_rows") > 1) | F.col("_is_new").isNull()).drop("_is_new")


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = "_is_repeated",
    among: DataFrame | None = None,
    spread: str | None = None,
    min_rows: int = HOT_ROWS,
    first_seen: DataFrame | None = None,
) -> DataFrame:
    """Every row plus a boolean: does its key occur more than once (in ``among``, if given)?

    Keys are counted with partial aggregation and joined back; the counts themselves name the keys
    whose rows must be spread, and rows with a NULL key part are spread over all tasks.  See
    :func:`tidegate.operators.skew.salted_join` for ``spread`` and :func:`repeated_keys` for
    ``first_seen``.
    """
    counted = repeated_keys(df if among is None else among, keys, first_seen)
    hot = (
        counted.where(F.col("key_rows") >= min_rows)
        .orderBy(F.desc("key_rows"))
        .limit(HOT_KEYS)
    )
    repeated = counted.select(*keys, F.lit(True).alias(flag))
    joined = salted_join(df, repeated, keys, "left", hot=hot, spread=spread, min_rows=min_rows)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def unique_check(keys: Sequence[str], flag: str = "_is_repeated", severity: str = SOFT) -> Check:
    return Check("_".join(keys) + "__unique", keys[0], severity, ~F.col(flag))


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, parent_key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(parent_key).alias(foreign_key)).where(F.col(foreign_key).isNotNull()).distinct()
    candidates = child.where(F.col(foreign_key).isNotNull())
    return salted_join(candidates, parents, [foreign_key], "left_anti", min_rows=min_rows)


def flag_orphans(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str,
    flag: str = "_is_orphan",
    spread: str | None = None,
    min_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Every child row plus a boolean: is its non-NULL foreign key without a parent?  ``hot`` is
    the list of hot keys where the caller has it already."""
    parents = (
        parent.select(F.col(parent_key).alias(foreign_key))
        .where(F.col(foreign_key).isNotNull())
        .distinct()
        .withColumn(flag, F.lit(False))
    )
    joined = salted_join(child, parents, [foreign_key], "left", hot=hot, spread=spread, min_rows=min_rows)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.col(foreign_key).isNotNull()))


def exists_check(foreign_key: str, flag: str = "_is_orphan", severity: str = SOFT) -> Check:
    return Check(f"{foreign_key}__exists", foreign_key, severity, ~F.col(flag))
