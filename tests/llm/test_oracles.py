"""Every registered query of the subpackage that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from sparkmart.llm import oracles, queries

from .. import oracle_check

SF_DIR = "/root/testdata/sf0.01"
ORACLES = oracles.build()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    db = oracle_check.connect(SF_DIR)
    names, rows = oracle_check.spark_rows(queries.queries()[name](spark, SF_DIR))
    wanted_names, wanted = oracle_check.oracle_rows(db, ORACLES[name])
    assert names == wanted_names
    assert rows and rows == wanted


def test_all_are_registered():
    registered = entry_points.queries()
    assert set(queries.queries()) <= set(registered) and "pipeline" in registered
    numbers = {int(n[2:].split("_")[0]) for n in queries.queries()}
    assert numbers == set(range(1, 14))
