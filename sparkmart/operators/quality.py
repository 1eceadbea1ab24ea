"""Data-quality tests: unique, not_null, accepted_values.

A test counts what fails it: for ``unique`` the non-NULL values that occur more
than once, for ``not_null`` the rows holding NULL, for ``accepted_values`` the
distinct non-NULL values outside the list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    ORDER_STATUSES,
    PRICE_TIERS,
    SIGNUP_SEGMENTS,
    STOCK_STATUSES,
    VALUE_TIERS,
    labels,
)

TESTS = ("unique", "not_null", "accepted_values")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()


def _checks(model: str, column: str, *tests: str, values=()) -> list[Check]:
    found = [Check(model, column, test) for test in tests]
    return found + ([Check(model, column, "accepted_values", values)] if values else [])


# The columns tested, by which tests.
SUITE: tuple[Check, ...] = tuple(
    _checks("stg_orders", "order_id", "unique", "not_null")
    + _checks("stg_orders", "customer_id", "not_null")
    + _checks("stg_orders", "amount", "not_null")
    + _checks("stg_orders", "status", "not_null", values=ORDER_STATUSES)
    + _checks("stg_customers", "customer_id", "unique", "not_null")
    + _checks("stg_customers", "email", "unique", "not_null")
    + _checks(
        "stg_customers", "customer_segment", "not_null", values=labels(SIGNUP_SEGMENTS)
    )
    + _checks("stg_products", "product_id", "unique", "not_null")
    + _checks("stg_products", "price_tier", values=labels(PRICE_TIERS))
    + _checks("stg_products", "stock_status", values=labels(STOCK_STATUSES))
    + _checks("mart_sales", "order_id", "unique", "not_null")
    + _checks("mart_sales", "customer_id", "not_null")
    + _checks("mart_sales", "amount", "not_null")
    + _checks("mart_customers", "customer_id", "unique", "not_null")
    + _checks(
        "mart_customers", "customer_value_tier", "not_null", values=labels(VALUE_TIERS)
    )
)


def _outside(check: Check) -> Column:
    return F.col(check.column).isNotNull() & ~F.col(check.column).isin(*check.values)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (for ``not_null``) or values with their counts that fail a test."""
    if check.test == "not_null":
        return df.filter(F.col(check.column).isNull())
    if check.test == "accepted_values":
        return (
            df.filter(_outside(check))
            .groupBy(F.col(check.column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
    if check.test == "unique":
        return (
            df.filter(F.col(check.column).isNotNull())
            .groupBy(F.col(check.column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
        )
    raise ValueError(f"unknown test {check.test!r}")


def _name(check: Check) -> list[Column]:
    return [
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.test).alias("test"),
    ]


def _run_model(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All tests of one model, from one evaluation of the columns they look at.

    A row is handed on once for each ``unique`` test, and once for each value outside its list;
    values keep their types. What is handed on is counted per value in each task before it is
    shuffled, so a value that fills a third of the table costs one row per task. Rows with
    NULL are summed along with the first test.
    """
    valued = [c for c in checks if c.test != "not_null"]
    missing = [c for c in checks if c.test == "not_null"]
    unique = [c for c in valued if c.test == "unique"]
    listed = [c for c in valued if c.test == "accepted_values"]

    def entry(check: Check | None) -> Column:
        """The place of the test, and the value in a column of its own."""
        values = (
            F.when(F.lit(c == check), F.col(c.column)).alias(f"value {k}")
            for k, c in enumerate(valued)
        )
        place = valued.index(check) if check else -1
        return F.struct(F.lit(place).alias("place"), *values)

    # Without a test that takes every row, all rows count as one group.
    every = [entry(c) for c in unique] or [entry(None)]
    first = valued.index(unique[0]) if unique else -1
    handed = F.array(*every)
    if listed:
        outside = (F.when(_outside(c), entry(c)) for c in listed)
        some = reduce(Column.__or__, map(_outside, listed))
        handed = F.when(some, F.array_compact(F.array(*every, *outside))).otherwise(handed)
    nulls = [
        F.col(c.column).isNull().cast("long").alias(f"null {k}")
        for k, c in enumerate(missing)
    ]
    counts = (
        df.select(*nulls, F.inline(handed))
        .groupBy("place", *(f"value {k}" for k in range(len(valued))))
        .agg(F.count("*").alias("n"), *(F.sum(f"null {k}").alias(f"null {k}") for k in range(len(missing))))
    )

    def failures(check: Check) -> Column:
        if check.test == "not_null":
            own = F.when(F.col("place") == first, F.col(f"null {missing.index(check)}"))
            return F.coalesce(F.sum(own), F.lit(0))
        place = valued.index(check)
        value = F.col(f"value {place}")
        own = (F.col("place") == place) & value.isNotNull()
        return F.count_if(own & (F.col("n") > 1) if check.test == "unique" else own)

    found = counts.agg(*(failures(c).alias(f"failures {k}") for k, c in enumerate(checks)))
    rows = (
        F.struct(*_name(c), F.col(f"failures {k}").alias("failures"))
        for k, c in enumerate(checks)
    )
    return found.select(F.inline(F.array(*rows)))


def run(
    models: Mapping[str, DataFrame],
    checks: Sequence[Check] = SUITE,
    tests: Sequence[str] = TESTS,
) -> DataFrame:
    """One row per test: model, column_name, test, failures, passed."""
    chosen = [check for check in checks if check.test in tests]
    reports = [
        _run_model(models[name], [check for check in chosen if check.model == name])
        for name in dict.fromkeys(check.model for check in chosen)
    ]
    return reduce(DataFrame.unionByName, reports).withColumn(
        "passed", F.col("failures") == 0
    )
