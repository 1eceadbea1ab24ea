"""Every registered query against its DuckDB statement on sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import oracle_queries

from . import oracle_check

SF_DIR = "/root/testdata/sf0.01"
ORACLES = oracle_queries.build()
#: The queries of a subpackage that may be absent have tests of their own.
QUERIES = {n: q for n, q in entry_points.queries().items() if n in ORACLES}


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(SF_DIR)


def test_names_agree():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, db, name):
    names, rows = oracle_check.spark_rows(QUERIES[name](spark, SF_DIR))
    wanted_names, wanted = oracle_check.oracle_rows(db, ORACLES[name])
    assert names == wanted_names
    assert len(rows) == len(wanted)
    assert rows == wanted
    assert rows


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
