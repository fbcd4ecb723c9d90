"""Schema evolution: may a batch join the partitions already stored?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidegate.contract import EvolutionPolicy
from tidegate.functions.hashing import HASH_EXCLUDED_PREFIXES

RUN_PREFIXES = (*HASH_EXCLUDED_PREFIXES, "_row_md5")


@dataclass(frozen=True)
class SchemaChange:
    added: list[str]
    removed: list[str]
    retyped: list[str]

    def violations(self, policy: EvolutionPolicy) -> list[str]:
        """What the policy forbids, as ``KIND:column``, in a fixed order.  A rename shows as a
        removal together with an addition."""
        found = []
        if policy.block_type_changes:
            found += [f"TYPE_CHANGE:{c}" for c in self.retyped]
        if policy.block_column_removal or (policy.block_renames and self.added):
            found += [f"COLUMN_REMOVED:{c}" for c in self.removed]
        if not policy.allow_additive_columns:
            found += [f"COLUMN_ADDED:{c}" for c in self.added]
        return found


def compare_schemas(stored: T.StructType, incoming: T.StructType) -> SchemaChange:
    """Content columns of a stored partition against those of a new batch.

    Columns that were stored as additive (see the field metadata written by enforcement) are not
    part of the contract, so a batch without them removes nothing.
    """

    def content(schema: T.StructType) -> dict[str, T.StructField]:
        return {
            f.name: f
            for f in schema.fields
            if not f.name.startswith(RUN_PREFIXES)
        }

    old, new = content(stored), content(incoming)
    return SchemaChange(
        added=sorted(set(new) - set(old)),
        removed=sorted(c for c, f in old.items() if c not in new and not f.metadata.get("additive")),
        retyped=sorted(c for c in set(old) & set(new) if old[c].dataType != new[c].dataType),
    )


def incompatibility(stored: T.StructType, incoming: T.StructType, policy: EvolutionPolicy) -> str | None:
    """Rejection reason for a batch that must not join the stored data, or None."""
    found = compare_schemas(stored, incoming).violations(policy)
    return "INCOMPATIBLE_SCHEMA:" + ",".join(found) if found else None
