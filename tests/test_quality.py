from __future__ import annotations

import pytest

from sparkmart.operators import quality
from sparkmart.operators.quality import Check


def test_suite_has_24_tests():
    assert len(quality.SUITE) == 24
    kinds = [c.test for c in quality.SUITE]
    assert [kinds.count(t) for t in quality.TESTS] == [6, 13, 5]


def test_counts_what_fails(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "x"), (2, "x"), (2, "y"), (3, None), (None, "a"), (None, None)],
        "k int, v string",
    )
    checks = (
        Check("m", "k", "unique"),
        Check("m", "k", "not_null"),
        Check("m", "v", "unique"),
        Check("m", "v", "not_null"),
        Check("m", "v", "accepted_values", ("a", "b")),
    )
    got = {
        (r.column_name, r.test): (r.failures, r.passed)
        for r in quality.run({"m": df}, checks).collect()
    }
    assert got == {
        ("k", "unique"): (2, False),
        ("k", "not_null"): (2, False),
        ("v", "unique"): (2, False),
        ("v", "not_null"): (2, False),
        ("v", "accepted_values"): (2, False),
    }
    failing = {
        (c.column, c.test): quality.failing_rows(df, c).count() for c in checks
    }
    assert failing == {key: failures for key, (failures, _) in got.items()}


def test_clean_and_empty_frames_pass(spark):
    checks = (
        Check("m", "k", "unique"),
        Check("m", "k", "not_null"),
        Check("m", "k", "accepted_values", ("1", "2")),
    )
    for rows in ([(1,), (2,)], []):
        df = spark.createDataFrame(rows, "k int")
        report = quality.run({"m": df}, checks)
        assert [tuple(r)[3:] for r in report.collect()] == [(0, True)] * 3


def test_unknown_test_raises(spark):
    with pytest.raises(ValueError):
        quality.failing_rows(spark.range(1), Check("m", "id", "other"))


def test_a_model_is_evaluated_once(spark, tmp_path):
    """All tests of a model come from one scan, of the tested columns only."""
    path = str(tmp_path / "m")
    spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, w string").write.parquet(path)
    checks = (
        Check("m", "k", "unique"),
        Check("m", "k", "not_null"),
        Check("m", "v", "unique"),
        Check("m", "v", "accepted_values", ("a",)),
    )
    report = quality.run({"m": spark.read.parquet(path)}, checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<k:int,v:string>" in plan
    assert sorted(tuple(r)[1:4] for r in report.collect()) == [
        ("k", "not_null", 0),
        ("k", "unique", 0),
        ("v", "accepted_values", 1),
        ("v", "unique", 0),
    ]


def test_no_job_runs_while_the_sales_mart_is_planned(spark, tmp_path):
    from sparkmart.plans import marts, staging

    from . import frames as f

    staged = (
        staging.stg_orders(f.orders(spark, f.order(1))),
        staging.stg_customers(f.customers(spark, f.customer(1))),
        staging.stg_products(f.products(spark, f.product(1))),
    )
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        marts.mart_sales(*staged)
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
