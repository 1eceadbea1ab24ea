from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.plans import staging

from . import frames as f


def test_order_status_and_flags(spark):
    raw = f.orders(
        spark,
        f.order(1, status="completed"),
        f.order(2, status="COMPLETED"),
        f.order(3, status=" completed "),
        f.order(4, status="Cancelled"),
        f.order(5, status=None),
    )
    rows = f.by(staging.stg_orders(raw), "order_id")
    got = {
        k: (r.status, r.is_completed, r.is_cancelled, r.completed_revenue)
        for k, r in rows.items()
    }
    ten, zero = Decimal("10.00"), Decimal("0.00")
    assert got == {
        1: ("completed", True, False, ten),
        2: ("completed", True, False, ten),
        3: ("completed", False, False, zero),
        4: ("cancelled", False, True, zero),
        5: (None, False, False, zero),
    }


def test_order_filters_and_variants(spark):
    raw = f.orders(
        spark,
        f.order(None),
        f.order(1, customer_id=None),
        f.order(2, amount=None),
        f.order(3, amount=0.0),
        f.order(4, amount=-1.0),
        f.order(5, amount=0.01),
        f.order(6, product_id=None),
    )
    assert set(f.by(staging.stg_orders(raw), "order_id")) == {5, 6}
    assert set(f.by(staging.stg_orders(raw, "lite"), "order_id")) == {1, 5, 6}


def test_order_types(spark):
    raw = f.orders(spark, f.order(1))
    types = dict(staging.stg_orders(raw, key_type="int").dtypes)
    assert types == {
        "order_id": "int",
        "customer_id": "int",
        "product_id": "int",
        "quantity": "int",
        "amount": "decimal(10,2)",
        "status": "string",
        "order_date": "date",
        "order_year": "int",
        "order_month": "int",
        "is_completed": "boolean",
        "is_cancelled": "boolean",
        "completed_revenue": "decimal(12,2)",
    }
    assert staging.stg_orders(raw).schema["order_id"].dataType == T.LongType()
    row = staging.stg_orders(raw).first()
    assert (row.order_date, row.order_year, row.order_month) == (
        dt.date(2001, 5, 6),
        2001,
        5,
    )


def test_wide_keys_pass_and_narrow_keys_abort(spark):
    raw = f.orders(spark, f.order(2**40))
    assert staging.stg_orders(raw).first().order_id == 2**40
    with pytest.raises(PySparkException):
        staging.stg_orders(raw, key_type="int").collect()


def test_bad_date_aborts(spark):
    raw = f.orders(spark, f.order(1, day="not a date"))
    with pytest.raises(PySparkException):
        staging.stg_orders(raw).collect()


def test_customer_segments(spark):
    as_of = dt.date(2001, 12, 31)
    ages = {1: 0, 2: 90, 3: 91, 4: 365, 5: 366}
    rows = [
        f.customer(k, day=str(as_of - dt.timedelta(days=age))) for k, age in ages.items()
    ]
    raw = f.customers(spark, *rows, f.customer(6, day=None))
    got = f.by(staging.stg_customers(raw, as_of=as_of), "customer_id")
    assert {k: r.customer_segment for k, r in got.items()} == {
        1: "New",
        2: "New",
        3: "Regular",
        4: "Regular",
        5: "Veteran",
        6: "Veteran",
    }
    assert {k: r.days_since_signup for k, r in got.items()} == ages | {6: None}


def test_customer_text_and_filters(spark):
    raw = f.customers(
        spark,
        f.customer(1, name="  Ann ", email=" A@B.C ", city="\tX "),
        f.customer(2, name=None),
        f.customer(3, email=None),
        f.customer(None),
    )
    row = staging.stg_customers(raw).first()
    # SQL TRIM takes spaces only: the tab stays.
    assert (row.customer_name, row.email, row.city) == ("Ann", "a@b.c", "\tX")
    assert set(f.by(staging.stg_customers(raw), "customer_id")) == {1}
    assert set(f.by(staging.stg_customers(raw, "lite"), "customer_id")) == {1, 2, 3}


def test_today_moves_unless_fixed(spark):
    raw = f.customers(spark, f.customer(1, day=str(dt.date.today())))
    assert staging.stg_customers(raw).first().days_since_signup in (0, 1)


def test_product_tiers(spark):
    prices = {
        1: (49.49, "Budget"),
        2: (49.50, "Budget"),
        3: (49.99, "Budget"),
        4: (50.00, "Mid-Range"),
        5: (199.50, "Mid-Range"),
        6: (199.99, "Mid-Range"),
        7: (200.00, "Premium"),
    }
    raw = f.products(
        spark,
        *(f.product(k, price=p) for k, (p, _) in prices.items()),
        f.product(8, price=0.0),
        f.product(9, price=None),
    )
    got = f.by(staging.stg_products(raw), "product_id")
    assert {k: r.price_tier for k, r in got.items()} == {
        k: tier for k, (_, tier) in prices.items()
    }


def test_stock_status(spark):
    stocks = {1: 0, 2: 1, 3: 9, 4: 10, 5: None}
    raw = f.products(spark, *(f.product(k, stock=s) for k, s in stocks.items()))
    got = f.by(staging.stg_products(raw), "product_id")
    assert [got[k].stock_status for k in sorted(got)] == [
        "Out of Stock",
        "Low Stock",
        "Low Stock",
        "In Stock",
        "In Stock",
    ]
    assert "stock_status" not in staging.stg_products(raw, "lite").columns


def test_unknown_variant(spark):
    with pytest.raises(ValueError):
        staging.model("stg_orders", "other")


ORDERS_AS_TEXT = (
    "order_id string, customer_id string, product_id string, quantity string, "
    "amount string, status string, order_date string, note string"
)


def test_rows_that_cannot_be_cast_are_set_aside(spark):
    good = ("1", "2", "3", "4", " 9.50 ", " Completed ", "2001-02-03", "n")
    rows = [
        good,
        ("2", None, "3", "4", "9.50", "pending", "2001-02-03", None),  # no customer
        ("3", "2", "3", "4", "0", "pending", "2001-02-03", None),  # amount not above 0
        ("x4", "2", "3", "many", "9.50", "pending", "2001-02-03", "bad"),
        ("5", None, "3", "4", "9,50", "pending", "2001-13-03", None),
        ("6", "2", "", "4", "123456789.00", None, None, None),
        ("7", "2", None, None, "1", None, None, None),  # NULLs are no failed casts
    ]
    raw = spark.createDataFrame(rows, ORDERS_AS_TEXT)
    typed, rejected = staging.model("stg_orders").checked(raw)
    kept = raw.filter("order_id in ('1', '7')").withColumn(
        "amount", F.col("amount").cast("decimal(10,2)")
    )
    assert sorted(map(repr, typed.collect())) == sorted(
        map(repr, staging.stg_orders(kept).collect())
    )
    assert typed.schema.simpleString() == staging.stg_orders(raw).schema.simpleString()
    found = rejected.selectExpr(
        "get_json_object(record, '$.order_id') as id", "column_name", "value", "wanted_type"
    )
    assert sorted(map(tuple, found.collect())) == [
        ("5", "amount", "9,50", "decimal(10,2)"),
        ("5", "order_date", "2001-13-03", "date"),
        ("6", "amount", "123456789.00", "decimal(10,2)"),
        ("6", "product_id", "", "bigint"),
        ("x4", "order_id", "x4", "bigint"),
        ("x4", "quantity", "many", "int"),
    ]
    assert rejected.filter("record like '%\"note\":\"bad\"%'").count() == 2


def test_checked_equals_plain_models_on_clean_rows(spark, tmp_path):
    """All models and variants, over raw tables without a failing value."""
    raw = {
        "stg_orders": [(1, 2, 3, 4, 9.5, "completed", "2001-02-03")],
        "stg_customers": [(1, " Ann ", "A@X", "c", "s", "2001-02-03"), (2, None, "b", "c", "s", None)],
        "stg_products": [(1, "p", "c", 50.0, 0), (2, "q", None, 0.0, 5), (3, "r", "c", None, None)],
    }
    schemas = {
        "stg_orders": "order_id long, customer_id long, product_id long, quantity long, "
        "amount double, status string, order_date string",
        "stg_customers": "customer_id long, name string, email string, city string, "
        "state string, created_at string",
        "stg_products": "product_id long, name string, category string, price double, stock long",
    }
    for variant in staging.VARIANTS:
        for name, rows in raw.items():
            frame = spark.createDataFrame(rows, schemas[name])
            model = staging.model(name, variant)
            typed, rejected = model.checked(frame, as_of="2002-01-01")
            wanted = model.frame(frame, as_of="2002-01-01")
            assert sorted(map(repr, typed.collect())) == sorted(map(repr, wanted.collect()))
            assert rejected.isEmpty()


def test_typed_and_rejected_rows_come_from_one_pass(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame(
        [("1", "2", "3", "4", "5", "s", "2001-01-01", None), ("x", "2", "3", "4", "5", "s", None, None)],
        ORDERS_AS_TEXT,
    ).write.parquet(path)
    typed, rejected = staging.model("stg_orders").checked(spark.read.parquet(path))
    for file in (tmp_path / "raw").iterdir():
        file.unlink()
    assert typed.count() == 1 and rejected.count() == 1
