"""Every registered query against its SQL oracle, at the smallest scale."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from comparison import connect, difference

import __spark_entry__ as entry
from tidegate.plans.oracles import all_oracles
from tidegate.plans.queries import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert difference(result, sql, con) is None


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_missing_library_takes_no_other_query_along():
    """The entry in a fresh interpreter in which a library of the training-data operators is hidden."""
    code = (
        "import sys, warnings; sys.modules['ahocorasick'] = None; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e; from tidegate.plans.queries import all_queries\n"
        "assert set(all_queries()) <= set(e.queries()); print(len(e.oracle_sql()))"
    )
    root = Path(entry.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= len(all_oracles())
