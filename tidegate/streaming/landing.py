"""Landing ingest as an incremental stream: take in whatever arrived since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidegate.contract import CORRUPT_COLUMN, Contract
from tidegate.functions.checks import Check
from tidegate.operators.enforce import SOURCE_COLUMN, judge
from tidegate.plans.ingest import Options, RunResult, annotate_batch, audit_row, write_outcomes
from tidegate.plans.workspace import new_folder
from tidegate.sinks.zones import Zones, write_records

#: How long a key of a date is remembered after it first came.
REMEMBERED = "2 days"
_KEY = "__first__"


def read_landing_stream(spark: SparkSession, folder: str, contract: Contract, files_at_once: int | None = None) -> DataFrame:
    """New CSV files with the contract's header.  A file whose header deviates stops the stream
    with an error; such files belong to the batch job, which maps headers."""
    reader = (
        spark.readStream.schema(contract.text_struct())
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("columnPruning", False)
        .option("pathGlobFilter", "*.csv")
    )
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.csv(folder).select("*", F.col("_metadata.file_path").alias(SOURCE_COLUMN))


def first_deliveries(
    rows: DataFrame, contract: Contract, keys: Sequence[str], run_date: str, remembered: str = REMEMBERED
) -> DataFrame:
    """The keys of acceptable rows, each only in the micro-batch that delivers it first on the date.

    Keyed state across micro-batches and runs: Spark keeps one entry per key and date and drops it
    when ``remembered`` has passed since it came.  Arrival is the time of the micro-batch, which is
    logged with it, so nothing is ever late and a replayed batch gives the same keys.  Keys with a
    NULL part are not compared.
    """
    accepted = judge(rows, contract).where(F.col("rejection_reason").isNull()).dropna(subset=list(keys))
    named = [F.col(k).alias(_KEY + k) for k in keys]
    come = accepted.select(*named, F.lit(run_date).alias("_key_date"), F.current_timestamp().alias("_arrived"))
    once = come.withWatermark("_arrived", remembered).dropDuplicatesWithinWatermark([*[_KEY + k for k in keys], "_key_date"])
    return once.drop("_arrived", "_key_date")


def start_ingest(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    zones: Zones,
    run_date: str,
    checkpoint: str,
    checks: Sequence[Check] | None = None,
    options: Options = Options(),
    files_at_once: int | None = None,
    remembered: str = REMEMBERED,
) -> StreamingQuery:
    """Process everything available, then stop.

    Each micro-batch owns ``dt=<date>/batch=<n>`` in the zones, so a batch that is replayed after
    a failure overwrites itself, and writes a summary and an audit row like a run of the batch job.

    Unique keys hold across the micro-batches and runs of a date (see :func:`first_deliveries`): a row
    is repeated if its key comes again in its own batch or has come in an earlier one.  The first
    delivery of a key is written before a later one can be known, so, unlike in the batch job, it is
    not flagged for what comes in later batches.  A date's runs must share the checkpoint.  The
    comparison with the stored schema works as in the batch job, batch by batch.
    """
    rows = read_landing_stream(spark, folder, contract, files_at_once)
    keys = list(options.unique_keys)
    if keys:
        # Rows and first deliveries of one micro-batch come to it together, told apart by the flag.
        marks = first_deliveries(rows, contract, keys, run_date, remembered).withColumn("_is_mark", F.lit(True))
        stream = rows.withColumn("_is_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    else:
        stream = rows

    def settle_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        if not keys:
            return batch, None
        # The state moves on once per batch: into a table, from which all steps read.
        table = new_folder(batch.sparkSession, "stream-batch")
        batch.write.parquet(table)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(table)
        marked = stored.where("_is_mark").select(*[F.col(_KEY + k).alias(k) for k in keys])
        return stored.where("NOT _is_mark").select(*rows.columns), marked

    def take(batch: DataFrame, batch_id: int) -> None:
        delivered, first_seen = settle_batch(batch)
        if first_seen is not None and delivered.isEmpty():
            return  # a batch that only clears the state
        annotated, errors, refused = annotate_batch([delivered], contract, zones, run_date, checks, options, first_seen)
        if options.keep:
            # The joins that flag repeated keys run once, not once for each zone.
            annotated = annotated.persist(StorageLevel.MEMORY_AND_DISK)
        part = f"{run_date}/batch={batch_id}"
        result = RunResult(contract.name, run_date, f"batch-{batch_id}", errors=errors)
        try:
            counts = write_outcomes(annotated, zones, result, options, part)
        finally:
            if options.keep:
                annotated.unpersist()
        result.close(counts, refused)
        write_records(audit_row(batch.sparkSession, result), zones.audit, part)

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
