"""The fixed reports, each from the tables or marts it reads.

Sorts that could tie carry a key as tie-break, so a limited result is the same
on every run and a global sort can split a hot sort value over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _money_sum(name: str) -> Column:
    return F.round(F.sum(name), 2)


def _mean(total: Column, count: Column) -> Column:
    """Mean of exact money as a double (a decimal mean would lose digits)."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def raw_category_summary(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed raw orders by category; ``completed`` is matched literally."""
    sold = orders.filter(F.col("status") == "completed").alias("o")
    shelf = products.select("product_id", "category").alias("p")
    return (
        sold.join(shelf, F.col("o.product_id") == F.col("p.product_id"), "left")
        .groupBy("p.category")
        .agg(
            F.count("o.order_id").alias("total_orders"),
            F.sum("o.amount").alias("total_revenue"),
            _mean(F.sum("o.amount"), F.count("o.amount")).alias("avg_order_value"),
            F.count_distinct("o.customer_id").alias("unique_customers"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def completed_orders_wide(
    orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Completed raw orders with customer and product names, newest first."""
    o = orders.filter(F.col("status") == "completed").alias("o")
    c, p = customers.alias("c"), products.alias("p")
    return (
        o.join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left")
        .join(p, F.col("o.product_id") == F.col("p.product_id"), "left")
        .select(
            "o.order_id",
            "o.order_date",
            "o.amount",
            "o.status",
            F.col("c.name").alias("customer_name"),
            "c.city",
            F.col("p.name").alias("product_name"),
            "p.category",
        )
        .orderBy(F.desc("order_date"), "order_id")
    )


def kpis(sales: DataFrame) -> DataFrame:
    """One row of headline figures, from one pass and one shuffle.

    Three of the four distinct counts are over ``order_id``, the fourth over
    ``customer_id``. Each row is sent as an order entry and a customer entry and
    folded per id (already before the shuffle, so a hot customer is one row per
    task); DISTINCT aggregates side by side would send it five times.
    """
    paid = F.when(F.col("is_completed"), F.col("amount"))
    order_entry = F.struct(
        F.lit(True).alias("is_order"),
        F.col("order_id").alias("id"),
        F.col("is_completed").alias("completed"),
        F.col("is_cancelled").alias("cancelled"),
        F.col("completed_revenue").alias("revenue"),
        paid.alias("paid"),
    )
    customer_entry = F.struct(
        F.lit(False).alias("is_order"),
        F.col("customer_id").alias("id"),
        F.lit(None).cast("boolean").alias("completed"),
        F.lit(None).cast("boolean").alias("cancelled"),
        F.when(F.lit(False), F.col("completed_revenue")).alias("revenue"),
        F.when(F.lit(False), F.col("amount")).alias("paid"),
    )
    per_id = (
        sales.select(F.inline(F.array(order_entry, customer_entry)))
        .groupBy("is_order", "id")
        .agg(
            F.bool_or("completed").alias("completed"),
            F.bool_or("cancelled").alias("cancelled"),
            F.sum("revenue").alias("revenue"),
            F.sum("paid").alias("paid"),
            F.count("paid").alias("paid_rows"),
        )
    )

    def ids(condition: Column) -> Column:
        return F.count(F.when(condition, F.col("id")))

    return per_id.agg(
        ids(F.col("is_order")).alias("total_orders"),
        ids(~F.col("is_order")).alias("total_customers"),
        _money_sum("revenue").alias("total_revenue"),
        F.round(_mean(F.sum("paid"), F.sum("paid_rows")), 2).alias("avg_order_value"),
        ids(F.col("completed")).alias("completed_orders"),
        ids(F.col("cancelled")).alias("cancelled_orders"),
    )


def revenue_by_month(sales: DataFrame) -> DataFrame:
    """Completed revenue per month; a month without sales has no row."""
    month = F.concat(
        F.col("order_year").cast("string"),
        F.lit("-"),
        F.lpad(F.col("order_month").cast("string"), 2, "0"),
    )
    return (
        sales.filter("is_completed")
        .groupBy("order_year", "order_month")
        .agg(_money_sum("completed_revenue").alias("revenue"))
        .orderBy(F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month"))
        .select(month.alias("month"), "revenue")
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(F.col("is_completed") & F.col("category").isNotNull())
        .groupBy("category")
        .agg(_money_sum("completed_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def customers_by_tier(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_value_tier").agg(
        F.count(F.lit(1)).alias("customers")
    )


def top_customers(customers: DataFrame, limit: int = 10) -> DataFrame:
    """Customers with the highest completed spend."""
    return (
        customers.filter(F.col("total_orders") > 0)
        .orderBy(F.desc("total_completed_spend"), "customer_id")
        .limit(limit)
        .select(
            "customer_name",
            "city",
            "state",
            "total_orders",
            F.round("total_completed_spend", 2).alias("total_spend"),
            "customer_value_tier",
        )
    )


def top_states(sales: DataFrame, limit: int = 10) -> DataFrame:
    """States with the highest completed revenue."""
    return (
        sales.filter(F.col("is_completed") & F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            _money_sum("completed_revenue").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "state")
        .limit(limit)
    )
