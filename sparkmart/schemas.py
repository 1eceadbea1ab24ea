"""Raw table schemas and the fixed values the models are defined by."""

from __future__ import annotations

from pyspark.sql import types as T

RAW, STAGING, MARTS = "raw", "staging", "marts"

RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

RAW_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("stock", T.LongType()),
    ]
)

RAW_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("order_date", T.StringType()),
    ]
)

# Bounds and labels that decide results. Each ladder is read from
# the top; the last label takes whatever no bound matched, NULL included.
SIGNUP_SEGMENTS = ((("<= 90", "New"), ("<= 365", "Regular")), "Veteran")
PRICE_TIERS = ((("< 50", "Budget"), ("< 200", "Mid-Range")), "Premium")
STOCK_STATUSES = ((("= 0", "Out of Stock"), ("< 10", "Low Stock")), "In Stock")
VALUE_TIERS = (
    ((">= 2000", "High Value"), (">= 500", "Mid Value"), ("> 0", "Low Value")),
    "No Orders",
)
ORDER_STATUSES = ("completed", "pending", "cancelled", "refunded")

#: Bare DECIMAL in the model definitions means 18 digits, 3 of them decimals.
BARE_DECIMAL = "decimal(18,3)"
MONEY = "decimal(10,2)"


def labels(ladder) -> tuple[str, ...]:
    """All labels a ladder can produce."""
    steps, rest = ladder
    return tuple(label for _, label in steps) + (rest,)
