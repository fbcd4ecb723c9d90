"""Landing to raw: annotate delivered rows, then write the valid and the refused ones.

The delivered text is parsed once.  The annotated rows are kept (memory, then local disk) while
the valid and the quarantine write use them.  With ``keep=False`` nothing is kept and the text is
parsed once per write, which needs no executor disk.  Rows are counted while they are written; the
summary is read from what was written: a column or two of Parquet, not the text again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidegate.contract import SOFT, Contract
from tidegate.functions.checks import Check, build_checks
from tidegate.operators.audit import (
    add_audit_columns,
    add_quarantine_columns,
    batch_metrics,
    reason_counts,
    split_metrics,
)
from tidegate.operators.enforce import SCHEMA_LAYER, SOURCE_COLUMN, diff_columns, finish, judge
from tidegate.operators.evolution import incompatibility
from tidegate.operators.manifests import verify_files
from tidegate.operators.quality import (
    DQ_LAYER,
    apply_checks,
    exists_check,
    flag_duplicates,
    flag_orphans,
    unique_check,
)
from tidegate.operators.skew import hot_values
from tidegate.sinks.zones import Zones, clear_date, write_date, write_records
from tidegate.sources.files import file_facts, read_manifests
from tidegate.sources.landing import read_landing
from tidegate.sources.zones import exists, latest_date, read_partition

SUCCESS, PARTIAL, FAILED = "SUCCESS", "PARTIAL", "FAILED"
_SPREAD = "__spread__"
REJECT_COLUMNS = ("rejection_reason", "rejection_layer", "raw_record")


@dataclass(frozen=True)
class Reference:
    """A foreign key of the dataset and the frame that must contain it."""

    column: str
    parent: DataFrame
    parent_column: str
    severity: str = SOFT


@dataclass(frozen=True)
class Options:
    as_of: str | None = None
    soft_fail_threshold: float | None = None
    escalate: bool = False
    unique_keys: Sequence[str] = ()
    unique_severity: str = SOFT
    references: Sequence[Reference] = ()
    hash_columns: Sequence[str] | None = None
    partition_columns: Sequence[str] = ()
    check_evolution: bool = True
    uniform_header: bool = False
    keep: bool = True
    #: Ingest files whose facts come without a checksum, in spite of a claimed one.
    allow_unhashed: bool = False


@dataclass
class RunResult:
    dataset: str
    run_date: str
    run_id: str
    status: str = SUCCESS
    read: int = 0
    schema_rejected: int = 0
    dq_failed: int = 0
    valid: int = 0
    warned: int = 0
    breach: bool = False
    escalated: bool = False
    errors: list[str] = field(default_factory=list)

    @property
    def quarantined(self) -> int:
        return self.schema_rejected + self.dq_failed

    def close(self, counts: dict[str, Any], refused: bool) -> None:
        """Take in the counts of what was written; ``refused`` says that the batch was refused whole."""
        for name, value in counts.items():
            setattr(self, name, int(value))
        self.status = FAILED if refused else SUCCESS if self.quarantined == 0 else PARTIAL


def new_run_id() -> str:
    return uuid.uuid4().hex[:8]


def annotate(
    delivered: DataFrame,
    contract: Contract,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    record_all: bool = False,
    first_seen: DataFrame | None = None,
) -> DataFrame:
    """Every delivered row with its typed values, DQ outcome and, where refused, the reason,
    the layer that refused it and the delivered text.

    The text is also kept where a row may be refused later: everywhere with ``record_all``, at soft
    findings with ``options.escalate``.  ``first_seen`` holds the unique keys that no earlier batch
    has delivered, where the rows are one batch of several.
    """
    if checks is None:
        checks = build_checks(contract.declared_rules(), options.as_of)
    # Enforcement has refused these NULLs already, so the checks could not find any.
    never_null = {c.name for c in contract.columns if c.reject_if_null}
    checks = [c for c in checks if not (c.kind == "not_null" and c.column in never_null)]
    judged = judge(delivered, contract)
    acceptable = F.col("rejection_reason").isNull()
    helpers = []
    if options.unique_keys or options.references:
        # Numbered once, at the scan: the joins below spread the rows of hot keys by it.
        judged = judged.withColumn(_SPREAD, F.monotonically_increasing_id())
        helpers.append(_SPREAD)
    scanned = judged
    if options.unique_keys:
        among = judged.where(acceptable)
        judged = flag_duplicates(
            judged, options.unique_keys, "_is_repeated", among=among, spread=_SPREAD, first_seen=first_seen
        )
        checks.append(unique_check(options.unique_keys, "_is_repeated", options.unique_severity))
        helpers.append("_is_repeated")
    # One pass finds the hot values of all foreign keys, over the rows as they come from the scan.
    hot = hot_values(scanned, sorted({ref.column for ref in options.references}))
    for n, ref in enumerate(options.references):
        flag = f"_is_orphan_{n}"
        judged = flag_orphans(judged, ref.parent, ref.column, ref.parent_column, flag, _SPREAD, hot=hot[ref.column])
        checks.append(exists_check(ref.column, flag, ref.severity))
        helpers.append(flag)

    checked = apply_checks(judged, checks, where=acceptable).drop(*helpers)
    failed = F.col("validation_flag") == 0
    layer = F.when(~acceptable, SCHEMA_LAYER).when(failed, DQ_LAYER)
    layered = checked.withColumns(
        {
            "rejection_layer": layer,
            "rejection_reason": F.coalesce("rejection_reason", F.when(failed, F.col("dq_failed_checks"))),
        }
    )
    recorded = F.lit(True) if record_all else F.col("rejection_layer").isNotNull()
    if options.escalate:
        recorded = recorded | F.coalesce(F.col("dq_status") == "WARN", F.lit(False))
    return finish(layered, recorded)


def annotate_all(
    frames: Sequence[DataFrame],
    contract: Contract,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    record_all: bool = False,
    first_seen: DataFrame | None = None,
) -> DataFrame:
    """Annotated rows of several header groups; columns only some have are NULL elsewhere."""
    parts = [annotate(f, contract, checks, options, record_all, first_seen) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def annotate_batch(
    frames: Sequence[DataFrame],
    contract: Contract,
    zones: Zones,
    run_date: str,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    first_seen: DataFrame | None = None,
) -> tuple[DataFrame, list[str], bool]:
    """Annotated rows of a batch, why parts of it are refused whole, and whether all of it is.

    With ``options.check_evolution`` a schema that must not join the stored one refuses the batch.
    """
    annotated = annotate_all(frames, contract, checks, options, first_seen=first_seen)
    blocked = [diff_columns(f.columns, contract).blocking_reason for f in frames]
    errors = sorted({b for b in blocked if b})
    if options.check_evolution:
        reason = _evolution_problem(frames[0].sparkSession, annotated, contract, zones, run_date)
        if reason:
            errors.append(reason)
            kept = annotate_all(frames, contract, checks, options, record_all=True, first_seen=first_seen)
            return refuse_all(kept, reason), errors, True
    return annotated, errors, all(blocked)


def refuse_all(annotated: DataFrame, reason: str) -> DataFrame:
    """The batch with every acceptable row refused for one reason."""
    free = F.col("rejection_layer").isNull()
    return annotated.withColumns(
        {
            "rejection_reason": F.coalesce("rejection_reason", F.lit(reason)),
            "rejection_layer": F.when(free, SCHEMA_LAYER).otherwise(F.col("rejection_layer")),
        }
    )


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("rejection_layer").isNull()).drop(*REJECT_COLUMNS, SOURCE_COLUMN)


def refused_rows(annotated: DataFrame) -> DataFrame:
    rows = annotated.where(F.col("rejection_layer").isNotNull()).drop("dq_failed_checks")
    return rows.withColumnRenamed(SOURCE_COLUMN, "source_file")


def ingest_frames(
    frames: Sequence[DataFrame],
    contract: Contract,
    zones: Zones,
    run_date: str,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    run_id: str | None = None,
) -> RunResult:
    """Annotate the delivered frames and overwrite the run's date in every zone."""
    date.fromisoformat(run_date)
    result = RunResult(contract.name, run_date, run_id or new_run_id())
    spark = frames[0].sparkSession
    annotated, result.errors, refused = annotate_batch(frames, contract, zones, run_date, checks, options)
    if options.keep:
        annotated = annotated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = write_outcomes(annotated, zones, result, options)
    finally:
        if options.keep:
            annotated.unpersist()

    result.close(counts, refused)
    write_records(audit_row(spark, result), zones.audit, run_date)
    return result


def write_outcomes(
    annotated: DataFrame, zones: Zones, result: RunResult, options: Options, part: str | None = None
) -> dict[str, Any]:
    """Write valid rows, refused rows and the summary of a run; returns its counts.

    ``part`` names what the run owns below ``dt=`` in each zone, by default its whole date.
    """
    run_date, run_id = result.run_date, result.run_id
    part = part or run_date

    def over_threshold(counts: dict[str, Any]) -> bool:
        checked = counts["read"] - counts["schema_rejected"]
        found = counts["dq_failed"] + counts["warned"]
        limit = options.soft_fail_threshold
        return limit is not None and checked > 0 and found / checked > limit

    if options.escalate:
        # The decision changes which rows are valid, so the counts are needed before any write.
        counts = annotated.agg(*batch_metrics()).first().asDict()
        result.breach = over_threshold(counts)
        if result.breach:
            result.escalated = True
            annotated = escalate_warnings(annotated)

    audited = add_audit_columns(
        valid_rows(annotated), zones.dataset, run_date, run_id, options.hash_columns
    )
    refused = add_quarantine_columns(refused_rows(annotated), run_id)
    # Both writes count their rows on the way: every row is in one of them.
    counted = [Observation(), Observation()]
    valid_counts, refused_counts = ([m.alias(n) for n, m in metrics.items()] for metrics in split_metrics())
    write_date(audited.observe(counted[0], *valid_counts), zones.valid, part, options.partition_columns)
    write_date(refused.observe(counted[1], *refused_counts), zones.quarantine, part)
    counts = counted[0].get | counted[1].get
    counts = {"read": counts["valid"] + counts["schema_rejected"] + counts["dq_failed"], **counts}
    stored_refused = annotated.sparkSession.read.schema(refused.schema).parquet(f"{zones.quarantine}/dt={part}")
    if not options.escalate:
        result.breach = over_threshold(counts)
    context = ["source_file"] if "source_file" in stored_refused.columns else []
    summary = reason_counts(stored_refused, *context).select(
        F.lit(zones.dataset).alias("dataset"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.current_timestamp().alias("summary_ts"),
        "*",
    )
    write_records(summary, zones.summary, part)
    return counts


def escalate_warnings(annotated: DataFrame) -> DataFrame:
    """Rows with soft findings are refused too."""
    warned = F.col("rejection_layer").isNull() & (F.col("dq_status") == "WARN")

    def instead(name: str, value: Column) -> Column:
        return F.when(warned, value).otherwise(F.col(name))

    return annotated.withColumns(
        {
            "rejection_reason": instead("rejection_reason", F.col("dq_failed_checks")),
            "dq_status": instead("dq_status", F.lit("FAIL")),
            "validation_flag": instead("validation_flag", F.lit(0)),
            "rejection_layer": instead("rejection_layer", F.lit(DQ_LAYER)),
        }
    )


def _evolution_problem(
    spark: SparkSession, annotated: DataFrame, contract: Contract, zones: Zones, run_date: str
) -> str | None:
    """Compare with the latest earlier date that was not refused; schemas only, no rows are read
    (but for one audit row per date)."""
    refused: set[str] = set()
    if exists(spark, zones.audit):
        audit = spark.read.schema("run_date STRING, status STRING").json(zones.audit)
        refused = {r.run_date for r in audit.where(F.col("status") == FAILED).select("run_date").distinct().collect()}
    previous = latest_date(spark, zones.valid, "dt", before=run_date, besides=refused)
    if previous is None:
        return None
    stored = read_partition(spark, zones.valid, previous, contract.struct()).drop("dt", "batch").schema
    return incompatibility(stored, valid_rows(annotated).schema, contract.evolution)


def audit_row(spark: SparkSession, result: RunResult) -> DataFrame:
    row = asdict(result) | {"errors": "; ".join(result.errors)}
    schema = (
        "dataset STRING, run_date STRING, run_id STRING, status STRING, read BIGINT, "
        "schema_rejected BIGINT, dq_failed BIGINT, valid BIGINT, warned BIGINT, breach BOOLEAN, "
        "escalated BOOLEAN, errors STRING"
    )
    return spark.createDataFrame([row], schema)


def ingest_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: Contract,
    zones: Zones,
    run_date: str,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    run_id: str | None = None,
) -> RunResult:
    """Ingest delivered CSV files."""
    frames = read_landing(spark, paths, options.uniform_header)
    return ingest_frames(frames, contract, zones, run_date, checks, options, run_id)


def ingest_delivery(
    spark: SparkSession,
    landing: str,
    contract: Contract,
    zones: Zones,
    run_date: str,
    options: Options = Options(),
    run_id: str | None = None,
) -> RunResult:
    """The daily job: find the file of ``run_date``, verify it against its manifest, ingest it.

    A file that fails verification is not read, and what an earlier run of the date has left in the
    zones goes.  The result says what went wrong, also when the job itself fails, so that a caller can
    go on with other datasets.
    """
    day = date.fromisoformat(run_date)
    run_id = run_id or new_run_id()
    name = f"{contract.name}_{day:%Y%m%d}.csv"
    folder = f"{landing.rstrip('/')}/{contract.name}"
    try:
        errors = _delivery_errors(spark, folder, contract.name, name, options.allow_unhashed)
        if not errors:
            return ingest_files(
                spark, f"{folder}/{name}", contract, zones, run_date, None, options, run_id
            )
    except Exception as e:
        errors = [f"{type(e).__name__}: {e}"]
    return _failed(spark, zones, run_date, run_id, errors)


def _failed(spark: SparkSession, zones: Zones, run_date: str, run_id: str, errors: list[str]) -> RunResult:
    """A run that took in nothing.  It owns its date like any other: what an earlier run of the date
    has left in the zones goes, so that they never hold rows beside an audit row that says FAILED."""
    result = RunResult(zones.dataset, run_date, run_id, FAILED, errors=errors)
    for root in (zones.valid, zones.quarantine, zones.summary):
        clear_date(spark, root, run_date)
    write_records(audit_row(spark, result), zones.audit, run_date)
    return result


def ingest_deliveries(
    spark: SparkSession,
    landing: str,
    contracts: Sequence[Contract],
    base: str,
    run_date: str,
    options: Options = Options(),
    run_id: str | None = None,
) -> dict[str, RunResult]:
    """The daily job for several datasets, by name: all their files are verified in one join, those
    that pass are ingested, each into its zones below ``base``.  One that fails stops no other."""
    stamp = f"{date.fromisoformat(run_date):%Y%m%d}"
    run_id = run_id or new_run_id()
    landing = landing.rstrip("/")
    folders = [f"{landing}/{c.name}" for c in contracts if exists(spark, f"{landing}/{c.name}")]

    def verified() -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        if not folders:
            return found
        wanted = [(c.name, f"{c.name}_{stamp}.csv") for c in contracts]
        expected = spark.createDataFrame(wanted, "dataset_name STRING, file_name STRING")
        facts = file_facts(spark, folders, f"*_{stamp}.csv")
        claims = read_manifests(spark, folders, f"*_{stamp}_manifest.json")
        for row in verify_files(expected, facts, claims, allow_unhashed=options.allow_unhashed).select("dataset_name", "errors").collect():
            found.setdefault(row.dataset_name, []).extend(row["errors"])
        return found

    try:
        found = verified()
    except Exception:  # a file that cannot be read: each dataset is verified by itself
        found = None
    results = {}
    for contract in contracts:
        zones = Zones(base, contract.name)
        try:
            if found is None:
                folder, name = f"{landing}/{contract.name}", f"{contract.name}_{stamp}.csv"
                errors = _delivery_errors(spark, folder, contract.name, name, options.allow_unhashed)
            else:
                errors = found.get(contract.name, ["file_arrived: file not found"])
            if not errors:
                path = f"{landing}/{contract.name}/{contract.name}_{stamp}.csv"
                results[contract.name] = ingest_files(spark, path, contract, zones, run_date, None, options, run_id)
                continue
        except Exception as e:
            errors = [f"{type(e).__name__}: {e}"]
        results[contract.name] = _failed(spark, zones, run_date, run_id, errors)
    return results


def _delivery_errors(
    spark: SparkSession, folder: str, dataset: str, name: str, allow_unhashed: bool = False
) -> list[str]:
    if not exists(spark, folder):
        return ["file_arrived: file not found"]
    expected = spark.createDataFrame([(dataset, name)], "dataset_name STRING, file_name STRING")
    manifest = name.removesuffix(".csv") + "_manifest.json"
    facts, claims = file_facts(spark, folder, name), read_manifests(spark, folder, manifest)
    return list(verify_files(expected, facts, claims, allow_unhashed=allow_unhashed).first()["errors"])
