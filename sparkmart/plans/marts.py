"""Mart models: the order lines with their dimensions, and one row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tiers import ladder_sql
from ..operators.ranking import total_and_rank
from ..schemas import VALUE_TIERS

_FROM_ORDER = (
    "order_id",
    "order_date",
    "order_year",
    "order_month",
    "quantity",
    "amount",
    "status",
    "is_completed",
    "is_cancelled",
    "completed_revenue",
)
_FROM_CUSTOMER = ("customer_id", "customer_name", "city", "state", "customer_segment")
_FROM_PRODUCT = ("product_id", "product_name", "category", "price", "price_tier")
_CUSTOMER_FIELDS = (
    "customer_id",
    "customer_name",
    "email",
    "city",
    "state",
    "created_at",
    "customer_segment",
    "days_since_signup",
)


def sales_lines(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    variant: str = "core",
) -> DataFrame:
    """Every staged order with its customer and product, where they exist.

    Ids come from the dimension side, so an order whose customer was dropped in
    staging has a NULL ``customer_id`` here. A hot customer or product (or a mass
    of NULL keys) sits on the left of a left join, the side the skew-join rule
    can split.
    """
    product_fields = _FROM_PRODUCT + (("stock_status",) if variant == "core" else ())
    o, c, p = orders.alias("o"), customers.alias("c"), products.alias("p")
    return (
        o.join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left")
        .join(p, F.col("o.product_id") == F.col("p.product_id"), "left")
        .select(
            *(f"o.{name}" for name in _FROM_ORDER),
            *(f"c.{name}" for name in _FROM_CUSTOMER),
            *(f"p.{name}" for name in product_fields),
        )
    )


def _counted(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Category, amount and revenue of the sales lines, and how many ``copies`` each stands for.

    Customers matter only where an id occurs more than once, as each such row repeats
    its orders. Ids are unique as a rule, so the right side is empty, which is seen when the
    plan runs, and the join is left out then.
    """
    repeated = (
        customers.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    return (
        orders.join(repeated, "customer_id", "left")
        .join(products.select("product_id", "category"), "product_id", "left")
        .select(
            "category",
            "amount",
            "completed_revenue",
            F.coalesce("copies", F.lit(1)).alias("copies"),
        )
    )


def mart_sales(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    variant: str = "core",
) -> DataFrame:
    """:func:`sales_lines`, in core with category total and rank in category."""
    lines = sales_lines(orders, customers, products, variant)
    if variant == "lite":
        return lines
    return total_and_rank(
        lines,
        group="category",
        value="amount",
        measure="completed_revenue",
        total="category_total_revenue",
        rank="rank_in_category",
        counted=_counted(orders, customers, products),
        weight="copies",
    )


def _spend_by_customer(orders: DataFrame) -> DataFrame:
    """Order measures per customer; partial sums leave no hot key to shuffle."""
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_if("is_completed").alias("completed_orders"),
            F.count_if("is_cancelled").alias("cancelled_orders"),
            F.sum("amount").alias("total_spend"),
            F.sum("completed_revenue").alias("total_completed_spend"),
            (F.sum("amount").cast("double") / F.count("amount")).alias(
                "avg_order_value"
            ),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.date_diff(F.max("order_date"), F.min("order_date")).alias(
                "customer_lifespan_days"
            ),
        )
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def mart_customers(
    orders: DataFrame, customers: DataFrame, variant: str = "core"
) -> DataFrame:
    """One row per customer with spend measures and value tier.

    Orders are aggregated before the join in both variants. The lite model is
    defined as "join, then group by all customer columns", where equal customer
    rows fall into one group and so count their orders once each; the same
    result comes from grouping the customers first and scaling by their number,
    without ever joining a hot customer's orders row by row.
    """
    spend = _spend_by_customer(orders)
    if variant == "lite":
        customers = customers.groupBy(*_CUSTOMER_FIELDS).agg(
            F.count(F.lit(1)).alias("_copies")
        )
        spend = spend.select(
            "customer_id", "total_orders", "total_completed_spend", "avg_order_value"
        )
    joined = customers.join(spend, "customer_id", "left")
    tier = F.expr(ladder_sql("total_completed_spend", VALUE_TIERS))
    if variant == "lite":
        measures = [
            (F.col("_copies") * F.coalesce("total_orders", F.lit(0))).alias(
                "total_orders"
            ),
            (
                F.col("_copies") * F.coalesce("total_completed_spend", F.lit(0))
            ).alias("total_completed_spend"),
            _or_zero("avg_order_value"),
        ]
    else:
        measures = [
            _or_zero("total_orders"),
            _or_zero("completed_orders"),
            _or_zero("cancelled_orders"),
            _or_zero("total_spend"),
            _or_zero("total_completed_spend"),
            _or_zero("avg_order_value"),
            F.col("first_order_date"),
            F.col("last_order_date"),
            _or_zero("customer_lifespan_days"),
        ]
    return joined.select(*_CUSTOMER_FIELDS, *measures).withColumn(
        "customer_value_tier", tier
    )
