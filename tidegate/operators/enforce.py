"""Contract enforcement: column differences, null tokens, typed casts, row rejection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.contract import CORRUPT_COLUMN, Contract
from tidegate.functions.casts import is_text, to_contract_type
from tidegate.functions.hashing import HASH_EXCLUDED_PREFIXES
from tidegate.functions.text import blank_to_null, cleanser
from tidegate.operators.settle import settle

SCHEMA_LAYER = "SCHEMA_ENFORCEMENT"
SOURCE_COLUMN = "_source_file"

# Columns a frame may carry besides the delivered ones.
CARRIED = (CORRUPT_COLUMN, SOURCE_COLUMN)

# Names the zones need for themselves; a delivered column must not take them.
RESERVED = frozenset(
    "rejection_reason rejection_layer raw_record source_file quarantine_ts pipeline_run_id dq_status "
    "dq_failed_checks validation_flag _raw_load_ts _pipeline_run_id _source_dataset _dt _row_md5 dt".split()
)

# Working columns: a delivered text, and the same text with null tokens removed.
_DELIVERED, _TEXT = "__delivered__", "__text__"


@dataclass(frozen=True)
class ColumnDiff:
    additive: list[str]
    missing_mandatory: list[str]
    missing_optional: list[str]
    ambiguous: list[str]

    @property
    def blocking_reason(self) -> str | None:
        """Why the whole batch is refused, or None when it can be processed."""
        if self.missing_mandatory:
            return "MISSING_MANDATORY_COLUMNS:" + ",".join(self.missing_mandatory)
        if self.ambiguous:
            return "AMBIGUOUS_COLUMNS:" + ",".join(self.ambiguous)
        return None


def diff_columns(incoming: Iterable[str], contract: Contract) -> ColumnDiff:
    """Compare delivered column names with the contract.  Names match exactly; a name that
    differs from a contract column only by case, that a zone uses itself, or that looks like run
    context and so would be left out of hashes and schema comparisons, would be ambiguous downstream."""
    given = {c for c in incoming if c not in CARRIED}
    declared = set(contract.names)
    folded = {n.lower() for n in declared}
    additive = given - declared
    return ColumnDiff(
        additive=sorted(additive),
        missing_mandatory=sorted(c.name for c in contract.mandatory if c.name not in given),
        missing_optional=sorted(c.name for c in contract.optional if c.name not in given),
        ambiguous=sorted(
            c for c in additive if c.lower() in folded | RESERVED or c.lower().startswith(HASH_EXCLUDED_PREFIXES)
        ),
    )


def _delivered(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in CARRIED]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def judge(df: DataFrame, contract: Contract) -> DataFrame:
    """Typed columns plus ``rejection_reason``, still next to the delivered texts.

    Building block of :func:`enforce`; finish with :func:`finish`.
    """
    diff = diff_columns(df.columns, contract)
    delivered = _delivered(df)
    carried = [F.col(c) for c in CARRIED if c in df.columns]
    present = set(delivered)
    extra = [c for c in delivered if c in set(diff.additive) - set(diff.ambiguous)]
    cast_columns = [c for c in contract.columns if c.name in present and not is_text(c)]

    # Three stacked projections: each step reads the columns of the one before, so a conversion
    # is evaluated once although both the typed value and the reason depend on it.
    cleaned = df.select(
        *[F.col(_quoted(c)).alias(_DELIVERED + c) for c in delivered],
        *[blank_to_null(F.col(_quoted(c))).alias(_TEXT + c) for c in delivered],
        *carried,
    )

    def typed(col):
        if col.name not in present:
            return F.lit(None).cast(col.type).alias(col.name)
        return to_contract_type(F.col(_quoted(_TEXT + col.name)), col).alias(col.name)

    shaped = cleaned.select(
        *[typed(c) for c in contract.columns],
        *[F.col(_quoted(_TEXT + c)).alias(c, metadata={"additive": True}) for c in extra],
        *[F.col(_quoted(_TEXT + c.name)) for c in cast_columns],
        *[F.col(_quoted(_DELIVERED + c)) for c in delivered],
        *carried,
    )

    reasons = []
    if CORRUPT_COLUMN in df.columns:
        reasons.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("CORRUPT_CSV_ROW")))
    for c in contract.columns:
        if c.reject_if_null and (c.mandatory or c.name in present):
            reasons.append(F.when(F.col(_quoted(c.name)).isNull(), F.lit(f"NULL_MANDATORY:{c.name}")))
    for c in cast_columns:
        failed = F.col(_quoted(c.name)).isNull() & F.col(_quoted(_TEXT + c.name)).isNotNull()
        reasons.append(F.when(failed, F.lit(f"TYPE_CAST_FAIL:{c.name}")))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    if diff.blocking_reason:
        reason = F.lit(diff.blocking_reason)

    dropped = {_TEXT + c.name for c in cast_columns}
    return shaped.select(
        *[F.col(_quoted(c)) for c in shaped.columns if c not in dropped],
        reason.alias("rejection_reason"),
    )


def finish(judged: DataFrame, rejected: Column) -> DataFrame:
    """Fold the delivered texts into ``raw_record``, kept only where ``rejected`` holds."""
    texts = [c for c in judged.columns if c.startswith(_DELIVERED)]
    if texts:
        record = F.to_json(F.struct(*[F.col(_quoted(c)).alias(c.removeprefix(_DELIVERED)) for c in texts]))
    else:
        record = F.lit(None).cast("string")
    if CORRUPT_COLUMN in judged.columns:
        record = F.coalesce(F.col(CORRUPT_COLUMN), record)
    hidden = {*texts, CORRUPT_COLUMN}
    return judged.select(
        *[F.col(_quoted(c)) for c in judged.columns if c not in hidden],
        F.when(rejected, record).alias("raw_record"),
    )


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Type and judge every row of an all-string frame; no row is lost.

    Result: contract columns (typed), additive columns (text), ``_source_file`` if given,
    ``rejection_reason`` (NULL = valid) and ``raw_record`` (the delivered texts as JSON, only on
    rejected rows).  The first reason wins: corrupt row, then mandatory NULLs, then failed casts,
    both in contract order.  A batch without a mandatory column is refused whole: all its rows
    come back with the same reason.
    """
    judged = settle(judge(df, contract), {"rejection_reason": F.col("rejection_reason")})
    return finish(judged, F.col("rejection_reason").isNotNull())


def schema_valid(enforced: DataFrame) -> DataFrame:
    return enforced.where(F.col("rejection_reason").isNull()).drop("rejection_reason", "raw_record")


def schema_rejected(enforced: DataFrame) -> DataFrame:
    return enforced.where(F.col("rejection_reason").isNotNull()).withColumn(
        "rejection_layer", F.lit(SCHEMA_LAYER)
    )


def cleanse(df: DataFrame, contract: Contract) -> DataFrame:
    """Apply the cleansing declared on contract columns, in one projection."""
    rules = {c.name: c.cleansing for c in contract.columns if c.cleansing}
    return df.select(
        *[
            cleanser(rules[c])(F.col(_quoted(c))).alias(c) if c in rules else F.col(_quoted(c))
            for c in df.columns
        ]
    )
