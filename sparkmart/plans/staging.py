"""Staging models: typed, trimmed, filtered views of the raw tables.

Each model is a set of named Spark SQL expressions plus row conditions. The same
text serves as a lazy DataFrame transformation (:meth:`StagingModel.frame`) and
as a catalog view (:meth:`StagingModel.view_sql`), so the two cannot drift apart.

A value that can't be cast aborts the query. :meth:`StagingModel.checked` sets such rows
aside instead: one pass over the raw table writes typed rows and rejected ones apart.

``variant="lite"`` keeps rows the core models drop; see the README.
Keys are 64-bit unless ``key_type="int"`` asks for 32-bit ones, which abort the
query past 2^31 rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tiers import ladder_sql
from ..schemas import (
    BARE_DECIMAL,
    MONEY,
    PRICE_TIERS,
    RAW,
    SIGNUP_SEGMENTS,
    STAGING,
    STOCK_STATUSES,
)
from ..sinks.files import stored

VARIANTS = ("core", "lite")


#: A cast of a raw column: the column and the type, which may have parameters.
_CAST = re.compile(r"\bcast\((\w+) as (\w+(?:\([^()]*\))?)\)", re.IGNORECASE)


class Checked(NamedTuple):
    """Rows that were typed, and one row for each value that could not be."""

    typed: DataFrame
    #: Raw row in JSON, and column_name, value, wanted_type of what failed.
    rejected: DataFrame


@dataclass(frozen=True)
class StagingModel:
    name: str
    source: str
    columns: Mapping[str, str]
    keep: tuple[str, ...]

    def _bound(self, text: str, as_of: date | str | None, key_type: str) -> str:
        today = "current_date()" if as_of is None else f"date'{as_of}'"
        return text.replace("{today}", today).replace("{key}", key_type)

    def frame(
        self,
        raw: DataFrame,
        as_of: date | str | None = None,
        key_type: str = "bigint",
    ) -> DataFrame:
        wanted = [
            f"{self._bound(text, as_of, key_type)} as {name}"
            for name, text in self.columns.items()
        ]
        return raw.filter(" and ".join(self.keep)).selectExpr(*wanted)

    def casts(self, key_type: str = "bigint") -> dict[str, str]:
        """The raw columns that are cast, and to what (the first cast of each counts)."""
        found: dict[str, str] = {}
        for text in self.columns.values():
            for column, kind in _CAST.findall(self._bound(text, None, key_type)):
                found.setdefault(column, kind)
        return found

    def checked(
        self,
        raw: DataFrame,
        as_of: date | str | None = None,
        key_type: str = "bigint",
    ) -> Checked:
        """Typed rows as of :meth:`frame`, and apart the rows in which a cast fails.

        A row with a value that isn't NULL and becomes NULL by ``try_cast`` is rejected as
        a whole, with one row for each such value; the model's conditions hold for the
        others. Both sides are written by one pass over ``raw``, to a table in the shared
        folder, so they belong together whatever ``raw`` does meanwhile.
        """

        def tried(text: str) -> str:
            return _CAST.sub(r"try_cast(\1 as \2)", text)

        casts = self.casts(key_type)
        # A condition compares what a column is cast to, never its text.
        conditions = " and ".join(
            re.sub(
                r"\b(\w+) (?=>)",
                lambda m: f"try_cast({m[1]} as {casts[m[1]]}) " if m[1] in casts else m[0],
                text,
            )
            for text in self.keep
        )
        failed = ", ".join(
            f"if({c} is not null and try_cast({c} as {kind}) is null, "
            f"struct('{c}' as column_name, cast({c} as string) as value, "
            f"'{kind.lower()}' as wanted_type), null)"
            for c, kind in casts.items()
        )
        typed = ", ".join(
            f"{tried(self._bound(text, as_of, key_type))} as {name}"
            for name, text in self.columns.items()
        )
        rows = raw.select(
            F.expr(f"filter(array({failed}), f -> f is not null)").alias("failed"),
            F.expr(f"struct({typed})").alias("typed"),
            F.to_json(F.struct(*(f"`{c}`" for c in raw.columns))).alias("record"),
            F.expr(f"coalesce({conditions}, false)").alias("wanted"),
        )
        side = (
            F.when(F.size("failed") > 0, "rejected").when(F.col("wanted"), "typed").alias("side")
        )
        both = stored(
            rows.select(
                side,
                F.when(side == "typed", F.col("typed")).alias("typed"),
                F.when(side == "rejected", F.col("failed")).alias("failed"),
                F.when(side == "rejected", F.col("record")).alias("record"),
            ).filter("side is not null"),
            "checked",
            partition_by=("side",),
        )
        return Checked(
            both.filter("side = 'typed'").select("typed.*"),
            both.filter("side = 'rejected'").select("record", F.inline("failed")),
        )

    def view_sql(
        self,
        raw_schema: str = RAW,
        schema: str = STAGING,
        as_of: date | str | None = None,
        key_type: str = "bigint",
    ) -> str:
        wanted = ", ".join(
            f"{self._bound(text, as_of, key_type)} as {name}"
            for name, text in self.columns.items()
        )
        return (
            f"create or replace view {schema}.{self.name} as select {wanted} "
            f"from {raw_schema}.{self.source} where {' and '.join(self.keep)}"
        )


_ordered = "cast(order_date as date)"
_paid = "lower(status) <=> 'completed'"
_signed_up = "cast(created_at as date)"
_age = f"datediff({{today}}, {_signed_up})"

_ORDER_COLUMNS = {
    "order_id": "cast(order_id as {key})",
    "customer_id": "cast(customer_id as {key})",
    "product_id": "cast(product_id as {key})",
    "quantity": "cast(quantity as int)",
    "amount": f"cast(amount as {MONEY})",
    "status": "lower(trim(status))",
    "order_date": _ordered,
    "order_year": f"year({_ordered})",
    "order_month": f"month({_ordered})",
    # The flags look at the untrimmed text, and NULL counts as "no".
    "is_completed": _paid,
    "is_cancelled": "lower(status) <=> 'cancelled'",
    "completed_revenue": f"cast(if({_paid}, cast(amount as {MONEY}), 0) as decimal(12,2))",
}

_CUSTOMER_COLUMNS = {
    "customer_id": "cast(customer_id as {key})",
    "customer_name": "trim(name)",
    "email": "lower(trim(email))",
    "city": "trim(city)",
    "state": "trim(state)",
    "created_at": _signed_up,
    "days_since_signup": _age,
    "customer_segment": ladder_sql(_age, SIGNUP_SEGMENTS),
}

_PRODUCT_COLUMNS = {
    "product_id": "cast(product_id as {key})",
    "product_name": "trim(name)",
    "category": "trim(category)",
    "price": f"cast(price as {MONEY})",
    "stock": "cast(stock as int)",
    "price_tier": ladder_sql(f"cast(price as {BARE_DECIMAL})", PRICE_TIERS),
}

_MODELS = {
    ("stg_orders", "core"): StagingModel(
        "stg_orders",
        "orders",
        _ORDER_COLUMNS,
        ("order_id is not null", "customer_id is not null", "amount > 0"),
    ),
    ("stg_orders", "lite"): StagingModel(
        "stg_orders", "orders", _ORDER_COLUMNS, ("order_id is not null", "amount > 0")
    ),
    ("stg_customers", "core"): StagingModel(
        "stg_customers",
        "customers",
        _CUSTOMER_COLUMNS,
        ("customer_id is not null", "name is not null", "email is not null"),
    ),
    ("stg_customers", "lite"): StagingModel(
        "stg_customers", "customers", _CUSTOMER_COLUMNS, ("customer_id is not null",)
    ),
    ("stg_products", "core"): StagingModel(
        "stg_products",
        "products",
        _PRODUCT_COLUMNS
        | {"stock_status": ladder_sql("cast(stock as int)", STOCK_STATUSES)},
        ("product_id is not null", "price > 0"),
    ),
    ("stg_products", "lite"): StagingModel(
        "stg_products",
        "products",
        _PRODUCT_COLUMNS,
        ("product_id is not null", "price > 0"),
    ),
}

STAGING_MODELS = ("stg_orders", "stg_customers", "stg_products")


def model(name: str, variant: str = "core") -> StagingModel:
    """Look a staging model up by name and variant."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    return _MODELS[name, variant]


def stg_orders(raw: DataFrame, variant: str = "core", **options) -> DataFrame:
    return model("stg_orders", variant).frame(raw, **options)


def stg_customers(raw: DataFrame, variant: str = "core", **options) -> DataFrame:
    return model("stg_customers", variant).frame(raw, **options)


def stg_products(raw: DataFrame, variant: str = "core", **options) -> DataFrame:
    return model("stg_products", variant).frame(raw, **options)
