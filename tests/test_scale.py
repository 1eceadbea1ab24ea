"""Plan shape: hot keys are split, scans are narrow, nothing is collected or crossed."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import oracle_queries
from sparkmart.operators import incremental
from sparkmart.plans import marts, reports, staging
from sparkmart.sinks import tables
from sparkmart.sinks.files import stored

SF_DIR = "/root/testdata/sf0.001"

# Sizes at which this fixture looks like a large skewed table to the optimizer.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shop(spark, hot_customer, hot_product, hot_amount):
    """40,000 orders, a third of them with the given hot values."""
    n, hot = 40_000, F.col("id") % 3 == 0
    orders = spark.range(n, numPartitions=8).select(
        F.col("id").alias("order_id"),
        F.when(hot & F.lit(hot_customer), 1).otherwise(F.col("id") % 5000).alias("customer_id"),
        F.when(hot & F.lit(hot_product), None).otherwise(F.col("id") % 997).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.when(hot & F.lit(hot_amount), F.lit("9.99").cast("decimal(10,2)"))
        .otherwise((F.col("id") % 30011 / 100 + 1).cast("decimal(10,2)"))
        .alias("amount"),
        F.when(F.col("id") % 2 == 0, "completed").otherwise("pending").alias("status"),
        F.lit("2001-05-06").alias("order_date"),
    )
    customers = spark.range(5000, numPartitions=8).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"),
        F.lit("a@b.c").alias("email"),
        F.lit("city").alias("city"),
        F.lit("state").alias("state"),
        F.lit("2000-01-01").alias("created_at"),
    )
    products = spark.range(997, numPartitions=8).select(
        F.col("id").alias("product_id"),
        F.lit("thing").alias("name"),
        F.lit("Books").alias("category"),
        F.lit(9.99).alias("price"),
        F.lit(5).alias("stock"),
    )
    return (
        staging.stg_orders(orders),
        staging.stg_customers(customers, as_of="2001-12-31"),
        staging.stg_products(products),
    )


@pytest.mark.parametrize("hot", ["customer", "missing product", "amount"])
def test_hot_keys_are_split(spark, hot):
    frames = shop(
        spark, hot == "customer", hot == "missing product", hot == "amount"
    )
    with settings(spark, LARGE):
        build = marts.mart_sales if hot == "amount" else marts.sales_lines
        plan = final_plan(build(*frames))
        assert "SortMergeJoin(skew=true)" in plan
        assert build(*frames).count() == 40_000


def test_hot_customer_is_aggregated_before_the_join(spark):
    orders, customers, _ = shop(spark, True, False, False)
    for variant in staging.VARIANTS:
        with settings(spark, LARGE):
            mart = marts.mart_customers(orders, customers, variant)
            plan = final_plan(mart)
        join = plan.index("SortMergeJoin")
        assert "partial_sum(amount" in plan[join:]
        assert mart.agg(F.sum("total_orders")).first()[0] == 40_000


def test_rank_windows_run_over_counts_only(spark):
    mart = marts.mart_sales(*shop(spark, False, False, True))
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_rows" in w or "_bucket_" in w for w in windows)
    assert not any("order_id" in w for w in windows)
    # Both branches over the counts share one shuffle of them.
    assert "ReusedExchange" in final_plan(mart)


def test_counting_pass_is_narrow(spark):
    orders, customers, products = (
        stored(frame, "narrow") for frame in shop(spark, False, False, True)
    )
    final = final_plan(marts.mart_sales(orders, customers, products))
    schemas = [part.split(">")[0] for part in final.split("ReadSchema: struct<")[1:]]
    # The second read of each table: join keys, category, amount, revenue only.
    # Ids of customers are unique here, so the counting pass joins none.
    assert schemas.count("product_id:bigint,category:string") == 1
    assert "product_id:bigint,category:string" in schemas
    assert any(
        "order_id" not in s and "amount" in s and "completed_revenue" in s for s in schemas
    )


def test_kpis_and_suite_take_one_pass(spark):
    sales = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit(True).alias("is_completed"),
        F.lit(False).alias("is_cancelled"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("completed_revenue"),
    )
    plan = final_plan(reports.kpis(sales))
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    assert "o_comment" not in plan and "o_orderdate" not in plan


def test_reports_read_few_columns_of_the_mart(spark, tmp_path):
    path = str(tmp_path / "mart")
    marts.sales_lines(*shop(spark, False, False, False)).write.parquet(path)
    mart = spark.read.parquet(path)
    plan = reports.revenue_by_category(mart)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema") :]
    assert scan.count(":") <= 5
    for name in ("is_completed", "category", "completed_revenue"):
        assert name in scan
    assert "IsNotNull(category)" in plan and "customer_name" not in plan


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(10).select(
        "id", F.concat(F.lit("2001-01-0"), F.col("id").cast("string")).alias("day")
    ).write.parquet(path)
    source = spark.read.parquet(path)
    for df in (
        incremental.since(source, "day", "2001-01-05"),
        incremental.last_days(source, "day", 4, as_of="2001-01-09"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(day,2001-01-05)" in plan
        assert df.count() == 5


def test_hot_month_is_split_on_write(spark):
    frames = shop(spark, False, False, False)
    spark.sql("create schema if not exists scale_marts")
    with settings(spark, LARGE):
        tables.replace_table(
            marts.sales_lines(*frames), "scale_marts.sales", ("order_year", "order_month")
        )
    held = spark.table("scale_marts.sales")
    assert held.count() == 40_000
    # All rows fall into one month, yet more than one task wrote them.
    assert held.select(F.input_file_name().alias("f")).distinct().count() > 1


@pytest.mark.parametrize("name", sorted(oracle_queries.build()))
def test_no_cross_joins_no_python(spark, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval", "Expand"):
        assert word not in plan, word
