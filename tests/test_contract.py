from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from tidegate.catalog import EMPLOYEE_MASTER, PAYROLL_TRANSACTIONS
from tidegate.contract import HARD, SOFT, Contract, find_contract, parse_type, read_contract

DOC = {
    "dataset": {"name": "people", "version": "v2", "table": "raw_people"},
    "mandatory_columns": [
        {"name": "id", "type": "LongType"},
        {"name": "mail", "type": "StringType", "reject_if_null": False, "regex": "@"},
    ],
    "optional_columns": [
        {"name": "born", "type": "DateType", "format": "dd/MM/yyyy"},
        {"name": "seen", "type": "TimestampType"},
        {"name": "kind", "allowed_values": ["a", "b"]},
    ],
    "dq_rules": [{"column": "kind", "check": "allowed_values", "allowed": ["a"], "severity": "HARD_FAIL"}],
    "schema_evolution": {"allow_additive_columns": False},
}


def test_document():
    c = Contract.from_mapping(DOC)
    assert (c.name, c.version, c.table, c.partition_column) == ("people", "v2", "raw_people", "dt")
    assert [x.reject_if_null for x in c.columns] == [True, False, False, False, False]
    assert c.struct()["born"].dataType == T.DateType()
    by_name = {x.name: x for x in c.columns}
    assert by_name["born"].parse_format == "dd/MM/yyyy"
    assert by_name["seen"].parse_format == "yyyy-MM-dd HH:mm:ss"
    assert not c.evolution.allow_additive_columns and c.evolution.block_type_changes


def test_declared_constraints_join_the_rules_once():
    rules = Contract.from_mapping(DOC).declared_rules()
    assert [(r.column, r.check, r.severity) for r in rules] == [
        ("kind", "allowed_values", HARD),
        ("mail", "regex_match", SOFT),
    ]


def test_unknown_type_and_severity_are_errors():
    with pytest.raises(ValueError):
        parse_type("DecimalType")
    bad = {**DOC, "dq_rules": [{"column": "id", "check": "not_null", "severity": "MAYBE"}]}
    with pytest.raises(ValueError):
        Contract.from_mapping(bad)


def test_repeated_column_is_an_error():
    with pytest.raises(ValueError):
        Contract.define("x", mandatory="a STRING", optional="A STRING")


def test_files_and_versions(tmp_path):
    (tmp_path / "people_v1.json").write_text(json.dumps(DOC | {"dataset": {"name": "people"}}))
    (tmp_path / "people_v2.json").write_text(json.dumps(DOC))
    assert find_contract("people", tmp_path).version == "v1"
    assert find_contract("people", tmp_path, {"people": "v2"}).version == "v2"
    with pytest.raises(FileNotFoundError):
        find_contract("people", tmp_path, {"people": "v3"})


def test_yaml(tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "people_v2.yaml"
    path.write_text(yaml.safe_dump(DOC))
    assert read_contract(path) == Contract.from_mapping(DOC)


def test_built_in_contracts():
    assert len(EMPLOYEE_MASTER.columns) == 25 and len(EMPLOYEE_MASTER.mandatory) == 5
    assert len(PAYROLL_TRANSACTIONS.columns) == 22 and len(PAYROLL_TRANSACTIONS.mandatory) == 5
