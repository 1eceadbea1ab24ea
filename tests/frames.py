"""Small literal raw frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS


def orders(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), RAW_ORDERS)


def customers(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), RAW_CUSTOMERS)


def products(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), RAW_PRODUCTS)


def order(order_id, customer_id=1, product_id=1, amount=10.0, status="completed", day="2001-05-06"):
    return (order_id, customer_id, product_id, 1, amount, status, day)


def customer(customer_id, name="Ann", email="a@b.c", city="X", state="S", day="2000-01-01"):
    return (customer_id, name, email, city, state, day)


def product(product_id, category="Books", price=10.0, stock=5, name="thing"):
    return (product_id, name, category, price, stock)


def by(df: DataFrame, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
