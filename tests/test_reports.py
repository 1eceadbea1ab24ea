from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.plans import marts, reports, staging

from . import frames as f


def lines(spark, orders, customers=None, products=None):
    return marts.sales_lines(
        staging.stg_orders(f.orders(spark, *orders)),
        staging.stg_customers(f.customers(spark, *(customers or [f.customer(1)]))),
        staging.stg_products(f.products(spark, *(products or [f.product(1)]))),
    )


def test_kpis(spark):
    sales = lines(
        spark,
        [
            f.order(1, amount=10.0),
            f.order(2, amount=5.0, customer_id=2),
            f.order(3, amount=100.0, status="cancelled"),
            f.order(4, amount=7.0, customer_id=99, status="pending"),
            # The same order twice counts once but is summed twice.
            f.order(1, amount=10.0),
        ],
        [f.customer(1), f.customer(2)],
    )
    row = reports.kpis(sales).first()
    assert row.asDict() == {
        "total_orders": 4,
        "total_customers": 2,
        "total_revenue": Decimal("25.00"),
        "avg_order_value": 8.33,
        "completed_orders": 2,
        "cancelled_orders": 1,
    }


def test_kpis_of_nothing(spark):
    row = reports.kpis(lines(spark, [f.order(1, amount=0.0)])).first()
    assert (row.total_orders, row.total_customers, row.completed_orders) == (0, 0, 0)
    assert row.total_revenue is None and row.avg_order_value is None


def test_kpis_of_only_open_orders(spark):
    row = reports.kpis(lines(spark, [f.order(1, status="pending")])).first()
    assert row.total_revenue == 0 and row.avg_order_value is None


def test_revenue_by_month_skips_absent_months(spark):
    sales = lines(
        spark,
        [
            f.order(1, day="2001-11-02"),
            f.order(2, day="2001-01-02"),
            f.order(3, day="2000-12-02"),
            f.order(4, day="2001-06-02", status="pending"),
        ],
    )
    assert [r.month for r in reports.revenue_by_month(sales).collect()] == [
        "2000-12",
        "2001-01",
        "2001-11",
    ]


def test_revenue_by_category_drops_null_and_sorts(spark):
    sales = lines(
        spark,
        [f.order(1), f.order(2, product_id=2, amount=20.0), f.order(3, product_id=3)],
        products=[f.product(1), f.product(2, category="Home"), f.product(3, category=None)],
    )
    got = [(r.category, r.revenue) for r in reports.revenue_by_category(sales).collect()]
    assert got == [("Home", 20), ("Books", 10)]


def test_top_customers_tie_break(spark):
    orders = staging.stg_orders(
        f.orders(spark, *(f.order(k, customer_id=k, amount=50.0) for k in range(1, 12)))
    )
    people = staging.stg_customers(
        f.customers(spark, *(f.customer(k, name=f"c{k:02}") for k in range(1, 13)))
    )
    top = reports.top_customers(marts.mart_customers(orders, people)).collect()
    assert [r.customer_name for r in top] == [f"c{k:02}" for k in range(1, 11)]


def test_top_states_counts_orders_once(spark):
    sales = lines(
        spark,
        [f.order(1), f.order(1), f.order(2, customer_id=2)],
        [f.customer(1, state="A"), f.customer(2, state="B")],
    )
    got = [tuple(r) for r in reports.top_states(sales).collect()]
    assert got == [("A", 1, Decimal("20.00")), ("B", 1, Decimal("10.00"))]


def test_raw_summary_is_case_sensitive(spark):
    orders = f.orders(
        spark,
        f.order(1),
        f.order(2, status="COMPLETED"),
        f.order(3, status=" completed "),
        f.order(4, product_id=None, amount=4.0),
    )
    got = f.by(
        reports.raw_category_summary(orders, f.products(spark, f.product(1))), "category"
    )
    assert {k: r.total_orders for k, r in got.items()} == {"Books": 1, None: 1}
    assert got["Books"].unique_customers == 1


def test_completed_orders_newest_first(spark):
    orders = f.orders(
        spark,
        f.order(1, day="2001-01-01"),
        f.order(2, day="2001-03-01"),
        f.order(3, day="2001-02-01", status="pending"),
    )
    wide = reports.completed_orders_wide(
        orders, f.customers(spark, f.customer(1)), f.products(spark, f.product(1))
    )
    assert [r.order_id for r in wide.collect()] == [2, 1]
    assert wide.columns == [
        "order_id",
        "order_date",
        "amount",
        "status",
        "customer_name",
        "city",
        "product_name",
        "category",
    ]


def test_customers_by_tier(spark):
    tiers = spark.range(4).select(
        F.when(F.col("id") < 3, "No Orders").otherwise("Low Value").alias("customer_value_tier")
    )
    got = {r[0]: r[1] for r in reports.customers_by_tier(tiers).collect()}
    assert got == {"No Orders": 3, "Low Value": 1}
