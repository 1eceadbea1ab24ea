from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkmart.operators.ranking import total_and_rank
from sparkmart.plans import marts, staging

from . import frames as f


def staged(spark, orders, customers, products, variant="core"):
    return (
        staging.stg_orders(f.orders(spark, *orders), variant),
        staging.stg_customers(f.customers(spark, *customers), variant, as_of="2001-12-31"),
        staging.stg_products(f.products(spark, *products), variant),
    )


def plain_windows(lines):
    group = Window.partitionBy("category")
    return lines.withColumns(
        {
            "category_total_revenue": F.sum("completed_revenue")
            .over(group)
            .cast("decimal(38,2)"),
            "rank_in_category": F.rank()
            .over(group.orderBy(F.desc_nulls_last("amount")))
            .cast("bigint"),
        }
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_left_joins_keep_unmatched_orders(spark):
    sales = marts.mart_sales(
        *staged(
            spark,
            [f.order(1), f.order(2, customer_id=9), f.order(3, product_id=None)],
            [f.customer(1)],
            [f.product(1)],
        )
    )
    got = f.by(sales, "order_id")
    assert len(sales.columns) == 23
    assert got[1].customer_id == 1 and got[1].category == "Books"
    assert got[2].customer_id is None and got[2].customer_name is None
    assert got[3].product_id is None and got[3].category is None


def test_rank_ties_and_null_category(spark):
    sales = marts.mart_sales(
        *staged(
            spark,
            [
                f.order(1, amount=10.0),
                f.order(2, amount=10.0, status="pending"),
                f.order(3, amount=5.0),
                f.order(4, amount=7.0, product_id=2),
                f.order(5, amount=8.0, product_id=None, status="pending"),
            ],
            [f.customer(1)],
            [f.product(1), f.product(2, category=None)],
        )
    )
    got = f.by(sales, "order_id")
    assert {k: r.rank_in_category for k, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 2, 5: 1}
    assert {k: r.category_total_revenue for k, r in got.items()} == {
        1: Decimal("15.00"),
        2: Decimal("15.00"),
        3: Decimal("15.00"),
        4: Decimal("7.00"),
        5: Decimal("7.00"),
    }


def test_duplicate_dimension_rows_multiply(spark):
    lines = marts.sales_lines(
        *staged(
            spark,
            [f.order(1), f.order(2, amount=4.0)],
            [f.customer(1), f.customer(1)],
            [f.product(1), f.product(1)],
        )
    )
    ranked = marts.mart_sales(
        *staged(
            spark,
            [f.order(1), f.order(2, amount=4.0)],
            [f.customer(1), f.customer(1)],
            [f.product(1), f.product(1)],
        )
    )
    assert lines.count() == 8
    assert rows_of(ranked) == rows_of(plain_windows(lines))


@pytest.mark.parametrize("seed", range(3))
def test_ranking_equals_plain_windows(spark, seed):
    rng = random.Random(seed)
    top = 99_999_999.99 if seed else 30.0
    rows = []
    for i in range(2000):
        amount = None if rng.random() < 0.02 else Decimal(str(round(rng.uniform(-5, top), 2)))
        if rng.random() < 0.33:
            amount = Decimal("9.99")
        paid = amount if amount is not None and rng.random() < 0.5 else Decimal(0)
        rows.append((i, rng.choice(["a", "a", "a", "", "=", "b", None]), amount, paid))
    df = spark.createDataFrame(
        rows, "id int, category string, amount decimal(10,2), completed_revenue decimal(12,2)"
    )
    ours = total_and_rank(
        df, "category", "amount", "completed_revenue", "category_total_revenue", "rank_in_category"
    )
    assert rows_of(ours) == rows_of(plain_windows(df))


def test_customer_tiers(spark):
    spends = {1: 0.01, 2: 499.99, 3: 500.0, 4: 1999.99, 5: 2000.0}
    orders = [f.order(k, customer_id=k, amount=v) for k, v in spends.items()]
    orders += [f.order(10, customer_id=6, status="pending"), f.order(11, customer_id=None)]
    mart = marts.mart_customers(
        *staged(spark, orders, [f.customer(k) for k in range(1, 8)], [])[:2]
    )
    got = f.by(mart, "customer_id")
    assert len(mart.columns) == 18
    assert {k: r.customer_value_tier for k, r in got.items()} == {
        1: "Low Value",
        2: "Low Value",
        3: "Mid Value",
        4: "Mid Value",
        5: "High Value",
        6: "No Orders",
        7: "No Orders",
    }
    assert (got[6].total_orders, got[6].total_completed_spend) == (1, 0)
    assert (got[7].total_orders, got[7].avg_order_value) == (0, 0.0)
    assert got[7].first_order_date is None and got[7].customer_lifespan_days == 0


def test_customer_measures(spark):
    orders = [
        f.order(1, amount=10.0, day="2001-01-01"),
        f.order(2, amount=20.0, day="2001-01-31", status="cancelled"),
        f.order(3, amount=3.0, day="2001-01-15", status="refunded"),
    ]
    row = marts.mart_customers(*staged(spark, orders, [f.customer(1)], [])[:2]).first()
    assert (row.total_orders, row.completed_orders, row.cancelled_orders) == (3, 1, 1)
    assert (row.total_spend, row.total_completed_spend) == (33, 10)
    assert row.avg_order_value == 11.0
    assert str(row.first_order_date) == "2001-01-01"
    assert row.customer_lifespan_days == 30


def test_lite_customers_equal_join_then_group(spark):
    orders, customers, _ = staged(
        spark,
        [f.order(1), f.order(2, amount=5.0, status="pending"), f.order(3, customer_id=None)],
        # Two equal rows, one differing row with the same key, one without orders.
        [f.customer(1), f.customer(1), f.customer(1, city="Y"), f.customer(2)],
        [],
        "lite",
    )
    fields = customers.columns
    wanted = (
        customers.join(orders, "customer_id", "left")
        .groupBy(*fields)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.coalesce(F.sum("completed_revenue"), F.lit(0)).alias("total_completed_spend"),
            F.coalesce(
                F.sum("amount").cast("double") / F.count("amount"), F.lit(0.0)
            ).alias("avg_order_value"),
        )
    )
    got = marts.mart_customers(orders, customers, "lite")
    assert rows_of(got.drop("customer_value_tier")) == rows_of(wanted)
    assert len(got.columns) == 12


def test_core_and_lite_agree_on_shared_columns(spark):
    rng = random.Random(7)
    orders = [
        f.order(i, customer_id=rng.randint(1, 20), amount=round(rng.uniform(1, 900), 2))
        for i in range(200)
    ]
    people = [f.customer(k) for k in range(1, 25)]
    core = marts.mart_customers(*staged(spark, orders, people, [])[:2])
    lite = marts.mart_customers(*staged(spark, orders, people, [], "lite")[:2], "lite")
    assert rows_of(core.select(lite.columns)) == rows_of(lite)
