"""Data contracts: the declared columns, types, rules and evolution policy of one dataset.

A contract is small, plan-time metadata.  It is turned into a ``StructType`` and into Column
expressions; it never travels with the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

HARD = "HARD_FAIL"
SOFT = "SOFT_FAIL"
SEVERITIES = (HARD, SOFT)

CORRUPT_COLUMN = "_corrupt_record"

DEFAULT_DATE_FORMAT = "yyyy-MM-dd"
DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def parse_type(name: str) -> T.DataType:
    """``DoubleType``, ``double`` or ``DOUBLE`` -> Spark type; anything else is an error."""
    key = name.strip().lower().removesuffix("type")
    if key not in _TYPES:
        raise ValueError(f"contract type {name!r} is not one of {sorted(_TYPES)}")
    return _TYPES[key]


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: T.DataType = T.StringType()
    mandatory: bool = False
    reject_if_null: bool = False
    format: str | None = None
    allowed_values: tuple[str, ...] = ()
    regex: str | None = None
    cleansing: str | None = None

    @property
    def parse_format(self) -> str | None:
        """Format used to parse text; dates and timestamps fall back to the defaults."""
        if isinstance(self.type, T.DateType):
            return self.format or DEFAULT_DATE_FORMAT
        if isinstance(self.type, T.TimestampType):
            return self.format or DEFAULT_TIMESTAMP_FORMAT
        return None


@dataclass(frozen=True)
class Rule:
    """One declared data-quality rule; ``params`` holds what the check kind needs."""

    column: str
    check: str
    severity: str = SOFT
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity {self.severity!r} is not one of {SEVERITIES}")


@dataclass(frozen=True)
class EvolutionPolicy:
    allow_additive_columns: bool = True
    block_type_changes: bool = True
    block_column_removal: bool = True
    block_renames: bool = True
    on_incompatible_change: str = "quarantine_and_alert"

    def __post_init__(self) -> None:
        if self.on_incompatible_change != "quarantine_and_alert":
            raise ValueError(f"cannot {self.on_incompatible_change!r} an incompatible batch, only quarantine it")


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    columns: tuple[ContractColumn, ...]
    rules: tuple[Rule, ...] = ()
    evolution: EvolutionPolicy = EvolutionPolicy()
    database: str | None = None
    table: str | None = None
    partition_column: str = "dt"

    def __post_init__(self) -> None:
        folded = [c.name.lower() for c in self.columns]
        repeated = sorted({n for n in folded if folded.count(n) > 1})
        if repeated:
            raise ValueError(f"contract {self.name}: repeated columns {repeated}")

    # -- views ---------------------------------------------------------------------------

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def mandatory(self) -> list[ContractColumn]:
        return [c for c in self.columns if c.mandatory]

    @property
    def optional(self) -> list[ContractColumn]:
        return [c for c in self.columns if not c.mandatory]

    def struct(self) -> T.StructType:
        """The typed schema of rows that passed the contract."""
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    def text_struct(self, header: Iterable[str] | None = None) -> T.StructType:
        """All-string schema for reading a delivered file, in ``header`` order, with the
        corrupt-record column at the end."""
        names = list(header) if header is not None else self.names
        fields = [T.StructField(n, T.StringType(), True) for n in names]
        return T.StructType([*fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

    def declared_rules(self) -> tuple[Rule, ...]:
        """``rules`` plus the constraints declared on columns (as soft rules) that no rule of
        the same column and kind already covers."""
        covered = {(r.column, r.check) for r in self.rules}
        extra: list[Rule] = []
        for c in self.columns:
            if c.allowed_values and (c.name, "allowed_values") not in covered:
                extra.append(Rule(c.name, "allowed_values", SOFT, {"allowed": list(c.allowed_values)}))
            if c.regex and (c.name, "regex_match") not in covered:
                extra.append(Rule(c.name, "regex_match", SOFT, {"pattern": c.regex}))
        return self.rules + tuple(extra)

    # -- construction --------------------------------------------------------------------

    @classmethod
    def define(
        cls,
        name: str,
        *,
        mandatory: str,
        optional: str = "",
        version: str = "v1",
        rules: Iterable[Rule] = (),
        details: Mapping[str, Mapping[str, Any]] | None = None,
        **table: Any,
    ) -> Contract:
        """Build a contract from two column lists (``"a STRING, b DOUBLE"``).

        ``details`` adds ``format``, ``allowed_values``, ``regex``, ``cleansing`` or
        ``reject_if_null`` to named columns.
        """
        details = details or {}
        columns = []
        for listed, required in ((mandatory, True), (optional, False)):
            for item in filter(str.strip, listed.split(",")):
                column, kind = item.split()
                col = ContractColumn(column, parse_type(kind), mandatory=required, reject_if_null=required)
                columns.append(replace(col, **_tupled(details.get(column, {}))))
        unknown = set(details) - {c.name for c in columns}
        if unknown:
            raise ValueError(f"details for unknown columns: {sorted(unknown)}")
        return cls(name, version, tuple(columns), tuple(rules), **table)

    @classmethod
    def from_mapping(cls, doc: Mapping[str, Any]) -> Contract:
        """Build a contract from a parsed contract document."""
        head = doc.get("dataset", {})
        columns = []
        for section, required in (("mandatory_columns", True), ("optional_columns", False)):
            for c in doc.get(section) or []:
                columns.append(
                    ContractColumn(
                        name=c["name"],
                        type=parse_type(c.get("type", "string")),
                        mandatory=required,
                        reject_if_null=c.get("reject_if_null", required or not c.get("nullable", True)),
                        format=c.get("format"),
                        allowed_values=tuple(str(v) for v in c.get("allowed_values") or ()),
                        regex=c.get("regex"),
                        cleansing=c.get("cleansing"),
                    )
                )
        fixed = {"column", "check", "severity"}
        rules = tuple(
            Rule(
                r["column"],
                r["check"],
                r.get("severity", SOFT),
                {k: v for k, v in r.items() if k not in fixed},
            )
            for r in doc.get("dq_rules") or []
        )
        return cls(
            name=head["name"],
            version=str(head.get("version", "v1")),
            columns=tuple(columns),
            rules=rules,
            evolution=EvolutionPolicy(**(doc.get("schema_evolution") or {})),
            database=head.get("database"),
            table=head.get("table"),
            partition_column=head.get("partition_col", "dt"),
        )


def _tupled(detail: Mapping[str, Any]) -> dict[str, Any]:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in detail.items()}


def read_contract(path: str | Path) -> Contract:
    """Read one contract document, JSON or YAML (YAML needs the optional ``yaml`` module)."""
    path = Path(path)
    text = path.read_text(encoding="utf-8")
    if path.suffix.lower() == ".json":
        return Contract.from_mapping(json.loads(text))
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError(f"{path}: reading YAML contracts needs the yaml module") from e
    return Contract.from_mapping(yaml.safe_load(text))


def find_contract(
    dataset: str, directory: str | Path, versions: Mapping[str, str] | None = None
) -> Contract:
    """Contract of ``dataset`` in ``directory``: ``<dataset>_<version>``, version ``v1`` unless
    ``versions`` pins another."""
    version = (versions or {}).get(dataset, "v1")
    for suffix in (".yaml", ".yml", ".json"):
        path = Path(directory) / f"{dataset}_{version}{suffix}"
        if path.exists():
            return read_contract(path)
    raise FileNotFoundError(f"no contract {dataset}_{version} in {directory}")
