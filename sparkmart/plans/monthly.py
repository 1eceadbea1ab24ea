"""The sales mart kept by month: new orders rewrite the months they fall in, no others.

Two tables stand for the mart, both partitioned by year and month of the order:

* the lines, with customer and product;
* the counts: lines per category, amount and completed revenue.

Total and rank of a category are sums over the counts of all months, so they follow from
the counts when the mart is read; the lines of untouched months are neither read nor
ranked again. A change of a customer or product calls for a full rebuild (``months=None``), as
it may touch any month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import total_and_rank
from ..sinks import tables
from . import marts, staging

LINES, COUNTS = "mart_sales_lines", "mart_sales_counts"
MONTH = ("order_year", "order_month")
_COUNTED = ("category", "amount", "completed_revenue")


def months_of(orders: DataFrame) -> list[tuple[int | None, int | None]]:
    """The months that staged orders fall in; a few hundred values at most."""
    return [tuple(r) for r in orders.select(*MONTH).distinct().collect()]


def _in_months(months: list[tuple[int | None, int | None]]) -> Column:
    tests = (
        F.col(MONTH[0]).eqNullSafe(F.lit(year)) & F.col(MONTH[1]).eqNullSafe(F.lit(month))
        for year, month in months
    )
    return reduce(Column.__or__, tests, F.lit(False))


def _counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_COUNTED, *MONTH).agg(F.count("*").alias("n_lines")).select(
        *_COUNTED, "n_lines", *MONTH
    )


def _rebuild(df: DataFrame, table: str) -> None:
    # A table's own option: the session's setting may be another for other tables.
    tables.replace_table(df, table, MONTH, partitionOverwriteMode="dynamic")


def _overwrite(df: DataFrame, table: str) -> None:
    """Replace those partitions of ``table`` that ``df`` has rows for."""
    ready = df.select(*df.sparkSession.table(table).columns).hint("rebalance", *MONTH)
    ready.write.insertInto(table, overwrite=True)


def refresh(
    spark: SparkSession,
    staging_schema: str,
    mart_schema: str,
    months: list[tuple[int | None, int | None]] | None = None,
) -> None:
    """Bring lines and counts of ``months`` (all when not given) up to the staged tables.

    Orders may be new or changed within a month, not taken out of it to leave it empty. A refresh
    that died is repaired by running it again. Counts are made of the written lines.
    """
    orders, customers, products = (
        spark.table(f"{staging_schema}.{name}") for name in staging.STAGING_MODELS
    )
    lines, counts = f"{mart_schema}.{LINES}", f"{mart_schema}.{COUNTS}"
    there = all(spark.catalog.tableExists(t) for t in (lines, counts))
    if months is None or not there:
        _rebuild(marts.sales_lines(orders, customers, products), lines)
        _rebuild(_counts(spark.table(lines)), counts)
        return
    touched = _in_months(months)
    _overwrite(marts.sales_lines(orders.filter(touched), customers, products), lines)
    _overwrite(_counts(spark.table(lines).filter(touched)), counts)


def mart_sales(spark: SparkSession, mart_schema: str) -> DataFrame:
    """The sales mart with total and rank per category, from lines and counts."""
    return total_and_rank(
        spark.table(f"{mart_schema}.{LINES}"),
        group="category",
        value="amount",
        measure="completed_revenue",
        total="category_total_revenue",
        rank="rank_in_category",
        counted=spark.table(f"{mart_schema}.{COUNTS}"),
        weight="n_lines",
    )
