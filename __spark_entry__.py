"""

Each query is a function of (spark, sf_dir) over the whole tables in ``sf_dir``.
Results are levelled to portable types on the way out (see ``_portable``): money
and means as DOUBLE, whole numbers as BIGINT, dates as text.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cached_property, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HERE = str(Path(__file__).resolve().parent)
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import oracle_queries  # noqa: E402
from oracle_queries import AS_OF, INCREMENTAL_SINCE, RECENT_AS_OF  # noqa: E402
from sparkmart import schemas  # noqa: E402
from sparkmart.operators import cleaning, incremental, profiling, quality  # noqa: E402
from sparkmart.plans import marts, monthly, pipeline, reports, staging  # noqa: E402
from sparkmart.session import fresh_path  # noqa: E402
from sparkmart.sinks import files, ledger, tables  # noqa: E402
from sparkmart.sources import delimited, rest, star  # noqa: E402



# The training-data operators, or a library that they need, may not be installed.
llm = corpus_pipeline = None
try:
    from sparkmart.llm import queries as llm

    import corpus_pipeline
except ImportError:
    pass

Query = Callable[[SparkSession, str], DataFrame]
SMOKE_DIR = "/root/testdata/sf0.001"


def _portable(df: DataFrame) -> DataFrame:
    def level(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(column, 6)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string")
        return column

    return df.select(*(level(f).alias(f.name) for f in df.schema))


class Inputs:
    """The frames of one data folder, each built once, when first asked for.

    Opening a Parquet table costs a Spark job that reads a footer.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, variant: str = "core", dirty: bool = True
    ):
        self.spark, self.sf_dir = spark, sf_dir
        self.variant, self.dirty = variant, dirty

    @cached_property
    def customers(self) -> DataFrame:
        return star.raw_customers(self.spark, self.sf_dir, self.dirty)

    @cached_property
    def products(self) -> DataFrame:
        return star.raw_products(self.spark, self.sf_dir, self.dirty)

    @cached_property
    def orders(self) -> DataFrame:
        return star.raw_orders(self.spark, self.sf_dir, self.dirty)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "orders": self.orders,
        }

    @cached_property
    def messy(self) -> dict[str, DataFrame]:
        """The raw tables with blanks, repeated rows and rows of NULLs planted."""
        return {
            "customers": star.messy(self.customers, "customer_id", "name"),
            "products": star.messy(self.products, "product_id", "category"),
            "orders": star.messy(self.orders, "order_id", "status"),
        }

    @cached_property
    def faulty(self) -> dict[str, DataFrame]:
        return star.faulty(self.models)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.orders, self.variant)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.customers, self.variant, as_of=AS_OF)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.products, self.variant)

    @cached_property
    def sales_lines(self) -> DataFrame:
        """The sales mart without its two window columns."""
        return marts.sales_lines(
            self.stg_orders, self.stg_customers, self.stg_products, self.variant
        )

    @cached_property
    def mart_sales(self) -> DataFrame:
        return marts.mart_sales(
            self.stg_orders, self.stg_customers, self.stg_products, self.variant
        )

    @cached_property
    def mart_customers(self) -> DataFrame:
        return marts.mart_customers(self.stg_orders, self.stg_customers, self.variant)

    @cached_property
    def models(self) -> dict[str, DataFrame]:
        """Models by name; no test reads the window columns of the sales mart."""
        return {
            "stg_orders": self.stg_orders,
            "stg_customers": self.stg_customers,
            "stg_products": self.stg_products,
            "mart_sales": self.sales_lines,
            "mart_customers": self.mart_customers,
        }


def _clean_report(t: Inputs) -> DataFrame:
    parts = [
        cleaning.clean_report(frame).withColumn("source", F.lit(name))
        for name, frame in t.messy.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _clean_headers(t: Inputs) -> DataFrame:
    messy = t.customers.toDF(
        " Customer-ID ", "Full Name", "E-Mail", "CITY", "Home State", "Sign-Up date"
    )
    return cleaning.normalise_headers(messy)


def _failing(t: Inputs) -> DataFrame:
    """What fails each kind of test, as text, over the models with planted faults."""
    found = [
        quality.failing_rows(t.faulty[check.model], check).select(
            F.lit(check.test).alias("test"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for check in (
            quality.Check("stg_orders", "order_id", "unique"),
            quality.Check("stg_customers", "email", "unique"),
            quality.Check(
                "stg_orders", "status", "accepted_values", schemas.ORDER_STATUSES
            ),
        )
    ]
    missing = quality.Check("stg_orders", "amount", "not_null")
    rows = quality.failing_rows(t.faulty["stg_orders"], missing).select(
        F.lit("not_null").alias("test"),
        F.col("order_id").cast("string").alias("value"),
        F.lit(1).cast("bigint").alias("n_records"),
    )
    return reduce(DataFrame.unionByName, found, rows)


def _csv_roundtrip(t: Inputs, name: str = "customers") -> DataFrame:
    folder = fresh_path(t.spark, "csv")
    files.write_csv(t.raw[name], folder)
    return delimited.load_and_clean(t.spark, folder)


def _json_roundtrip(t: Inputs) -> DataFrame:
    folder = fresh_path(t.spark, "json")
    record = F.to_json(
        F.struct(
            "customer_id",
            F.struct("name", "email", F.struct("city", "state").alias("place")).alias(
                "person"
            ),
        )
    )
    t.customers.select(record.alias("record")).write.text(f"{folder}/table=customers")
    return rest.read_landed(t.spark, folder, "customers").select(
        "customer_id",
        "person.name",
        "person.email",
        "person.place.city",
        "person.place.state",
    )


def _csv_malformed(t: Inputs) -> DataFrame:
    folder = fresh_path(t.spark, "csv")
    star.malformed_csv(t.orders, folder)
    return delimited.read_csv(t.spark, folder)


def _users(t: Inputs) -> DataFrame:
    """Customers as a service shows them, two objects deep."""
    return t.customers.select(
        F.col("customer_id").alias("id"),
        F.struct("name", "email").alias("person"),
        F.struct("city", F.struct("state", "created_at").alias("home")).alias("address"),
    )


def _rest_fetch(t: Inputs) -> DataFrame:
    folder = fresh_path(t.spark, "rest")
    pages = star.rest_pages(_users(t), "id", f"{folder}/service")
    return rest.fetch(t.spark, "", pages, f"{folder}/landed").select(
        F.col("id").alias("customer_id"),
        "person.name",
        "person.email",
        "address.city",
        "address.home.state",
        "address.home.created_at",
    )


def _api_frames(t: Inputs) -> dict[str, DataFrame]:
    """Three endpoints and an empty one, in pages written from the tables."""
    folder = fresh_path(t.spark, "api")
    posts = star.table(t.spark, t.sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.struct("source", F.struct("lang").alias("about")).alias("origin"),
        F.col("text").alias("body"),
    )
    todos = t.orders.select(
        F.col("order_id").alias("id"),
        F.col("customer_id").alias("userId"),
        F.col("status").alias("title"),
        (F.col("status") == "completed").alias("completed"),
    )
    endpoints = {
        name: star.rest_pages(frame, "id", f"{folder}/{name}")
        for name, frame in (("api_users", _users(t)), ("api_posts", posts), ("api_todos", todos))
    }
    nothing = star.rest_pages(posts.limit(0), "id", f"{folder}/api_comments")
    return pipeline.api_frames(
        t.spark,
        "",
        f"{folder}/copy",
        endpoints | {"api_comments": nothing},
        {"api_comments": posts.schema},
    )


def _api_load(t: Inputs) -> DataFrame:
    """The full load with its API half; all rows of the tables it makes of that."""
    api = _api_frames(t)

    def build(layers: pipeline.Layers) -> DataFrame:
        pipeline.run_full_load(t.spark, t.raw, api, layers=layers)
        wanted = {
            "api_users": ("id", "person.name", "address.home.state", "null"),
            "api_posts": ("id", "body", "origin.about.lang", "null"),
            "api_todos": ("id", "title", "cast(userId as string)", "completed"),
            "api_comments": ("id", "body", "origin.source", "null"),
        }
        parts = [
            t.spark.table(f"{layers.raw}.{name}").selectExpr(
                f"'{name}' as table_name",
                f"{key} as id",
                f"{text} as text",
                f"{about} as about",
                f"cast({flag} as boolean) as flag",
            )
            for name, (key, text, about, flag) in wanted.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    return _in_warehouse(t, build)


def _api_load_counts(t: Inputs) -> DataFrame:
    api = _api_frames(t)

    def build(layers: pipeline.Layers) -> DataFrame:
        report = pipeline.run_full_load(t.spark, t.raw, api, layers=layers)
        held = report.contents.select("table_name", "same_name_tables")
        rows = t.spark.createDataFrame(
            list(report.rows.items()), "table_name string, row_count long"
        )
        return rows.join(held, "table_name", "left")

    return _in_warehouse(t, build)


def _fresh_layers(spark: SparkSession) -> pipeline.Layers:
    """Three new schemas in the shared folder, apart from any other run's."""
    place, _, mark = fresh_path(spark, "warehouse").rpartition("-")
    layers = pipeline.Layers(f"raw_{mark}", f"staging_{mark}", f"marts_{mark}")
    tables.create_schemas(spark, layers.all, f"{place}-{mark}")
    return layers


def _in_warehouse(
    t: Inputs, build: Callable[[pipeline.Layers], DataFrame]
) -> DataFrame:
    """What ``build`` makes of three new schemas, which are dropped afterwards."""
    layers = _fresh_layers(t.spark)
    try:
        return files.stored(build(layers), "result")
    finally:
        tables.drop_schemas(t.spark, layers.all)


def _incremental_load(t: Inputs) -> DataFrame:
    """Load the past, then append what is due by the newest loaded date, twice."""
    key = F.when(F.col("order_id") % 1021 != 4, F.col("order_id"))
    orders = t.orders.withColumn("order_id", key)

    def build(layers: pipeline.Layers) -> DataFrame:
        target = f"{layers.raw}.orders"
        tables.load_table(orders.filter(F.col("order_date") <= INCREMENTAL_SINCE), target)
        for _ in range(2):
            held = t.spark.table(target)
            due = incremental.not_loaded(orders, held, "order_date", "order_id")
            tables.load_table(due.select(*held.columns), target, "append")
        return t.spark.table(target)

    return _in_warehouse(t, build)


def _append_twice(t: Inputs) -> DataFrame:
    """Batches through the ledger, one of them twice, and one that died before its line."""
    key = F.when(F.col("order_id") % 1021 != 4, F.col("order_id"))
    orders = t.orders.withColumn("order_id", key)

    def build(layers: pipeline.Layers) -> DataFrame:
        target = f"{layers.raw}.orders"

        def load(batch: str, rows: DataFrame) -> None:
            ledger.append_batch(rows, target, batch, "order_date")

        load("past", orders.filter(F.col("order_date") <= INCREMENTAL_SINCE))
        died = ledger.due(orders, target, "order_date", "order_id")
        died.withColumn(ledger.BATCH, F.lit("died")).write.insertInto(target)
        for batch in ("recent", "recent", "after"):
            load(batch, ledger.due(orders, target, "order_date", "order_id"))
        return ledger.rows(t.spark, target)

    return _in_warehouse(t, build)


def _mart_sales_monthly(t: Inputs) -> DataFrame:
    """The sales mart after two increments, each of which rewrites the months it touches."""
    day = F.col("order_date")
    middle = "2001-04-15"
    steps = (
        day < middle,
        (day >= middle) & (day < INCREMENTAL_SINCE),
        (day >= INCREMENTAL_SINCE) | day.isNull(),
    )

    def build(layers: pipeline.Layers) -> DataFrame:
        raw = f"{layers.raw}.orders"
        tables.load_table(t.customers, f"{layers.raw}.customers")
        tables.load_table(t.products, f"{layers.raw}.products")
        for k, step in enumerate(steps):
            new = t.orders.filter(step)
            tables.load_table(new, raw, "append" if k else "replace")
            if not k:
                pipeline.build_staging(t.spark, layers, as_of=AS_OF)
            months = monthly.months_of(staging.stg_orders(new)) if k else None
            monthly.refresh(t.spark, layers.staging, layers.marts, months)
        return monthly.mart_sales(t.spark, layers.marts)

    return _in_warehouse(t, build)


def _full_load(t: Inputs) -> DataFrame:
    return _in_warehouse(
        t, lambda layers: pipeline.run_full_load(t.spark, t.raw, layers=layers).summary
    )


def _load_counts(t: Inputs) -> DataFrame:
    def build(layers: pipeline.Layers) -> DataFrame:
        rows = pipeline.load_raw(t.spark, t.raw, layers)
        return t.spark.createDataFrame(
            list(rows.items()), "table_name string, row_count long"
        )

    return _in_warehouse(t, build)


def _warehouse_listing(t: Inputs) -> DataFrame:
    """The listing after load and build; schema names without their mark."""

    def build(layers: pipeline.Layers) -> DataFrame:
        pipeline.load_raw(t.spark, t.raw, layers)
        pipeline.build_models(t.spark, layers, as_of=AS_OF)
        schema = F.regexp_replace("table_schema", "_[0-9a-f]+$", "")
        return tables.list_tables(t.spark, layers.all).withColumn("table_schema", schema)

    return _in_warehouse(t, build)


def _warehouse_models(t: Inputs) -> DataFrame:
    def build(layers: pipeline.Layers) -> DataFrame:
        pipeline.load_raw(t.spark, t.raw, layers)
        pipeline.build_models(t.spark, layers, as_of=AS_OF)
        return pipeline.query(t.spark, f"select * from {layers.marts}.mart_sales")

    return _in_warehouse(t, build)


def _report_queries(suffix: str) -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        f"kpis{suffix}": lambda t: reports.kpis(t.sales_lines),
        f"revenue_by_month{suffix}": lambda t: reports.revenue_by_month(t.sales_lines),
        f"revenue_by_category{suffix}": lambda t: reports.revenue_by_category(
            t.sales_lines
        ),
        f"customers_by_tier{suffix}": lambda t: reports.customers_by_tier(
            t.mart_customers
        ),
        f"top_customers{suffix}": lambda t: reports.top_customers(t.mart_customers),
        f"top_states{suffix}": lambda t: reports.top_states(t.sales_lines),
    }


def _model_queries(suffix: str) -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        f"stg_orders{suffix}": lambda t: t.stg_orders,
        f"stg_customers{suffix}": lambda t: t.stg_customers,
        f"stg_products{suffix}": lambda t: t.stg_products,
        f"mart_sales{suffix}": lambda t: t.mart_sales,
        f"mart_customers{suffix}": lambda t: t.mart_customers,
    }


_CORE = {
    "scan_customers": lambda t: t.customers,
    "scan_products": lambda t: t.products,
    "scan_orders": lambda t: t.orders,
    "incremental_orders": lambda t: incremental.since(
        t.orders, "order_date", INCREMENTAL_SINCE
    ),
    "recent_orders_30d": lambda t: incremental.last_days(
        t.orders, "order_date", 30, RECENT_AS_OF
    ),
    "clean_drop_empty": lambda t: cleaning.drop_empty(t.messy["products"]),
    "clean_headers": _clean_headers,
    "clean_strip": lambda t: cleaning.strip_text(t.messy["customers"]),
    "clean_dedupe": lambda t: cleaning.drop_duplicates(t.messy["orders"]),
    "clean_report": _clean_report,
    "profile_shape": lambda t: profiling.shape(t.orders),
    "profile_nulls": lambda t: profiling.column_profile(t.orders),
    "profile_preview": lambda t: profiling.preview(t.orders, "order_id"),
    "raw_category_summary": lambda t: reports.raw_category_summary(
        t.orders, t.products
    ),
    "completed_orders_wide": lambda t: reports.completed_orders_wide(
        t.orders, t.customers, t.products
    ),
    **_model_queries(""),
    "stg_orders_checked": lambda t: staging.model("stg_orders")
    .checked(star.untyped(t.orders))
    .typed,
    "stg_orders_rejected": lambda t: staging.model("stg_orders")
    .checked(star.untyped(t.orders))
    .rejected.withColumn("order_key", F.get_json_object("record", "$.order_id"))
    .drop("record"),
    **_report_queries(""),
    "dq_unique": lambda t: quality.run(t.models, tests=("unique",)),
    "dq_not_null": lambda t: quality.run(t.models, tests=("not_null",)),
    "dq_accepted_values": lambda t: quality.run(t.models, tests=("accepted_values",)),
    "dq_suite": lambda t: quality.run(t.models),
    "dq_planted": lambda t: quality.run(t.faulty),
    "dq_failing_values": _failing,
    "dq_failing_rows": lambda t: quality.failing_rows(
        t.sales_lines, quality.Check("mart_sales", "customer_id", "not_null")
    ).select("order_id", "order_date", "amount"),
    "csv_roundtrip": _csv_roundtrip,
    "csv_roundtrip_products": lambda t: _csv_roundtrip(t, "products"),
    "csv_roundtrip_orders": lambda t: _csv_roundtrip(t, "orders"),
    "csv_malformed": _csv_malformed,
    "json_roundtrip": _json_roundtrip,
    "rest_fetch": _rest_fetch,
    "api_load": _api_load,
    "api_load_counts": _api_load_counts,
    "incremental_load": _incremental_load,
    "append_twice": _append_twice,
    "mart_sales_monthly": _mart_sales_monthly,
    "full_load": _full_load,
    "load_counts": _load_counts,
    "warehouse_listing": _warehouse_listing,
    "warehouse_models": _warehouse_models,
}
_LITE = {**_model_queries("_lite"), **_report_queries("_lite")}
_CLEAN = {"dq_suite_clean": lambda t: quality.run(t.models)}


def _bind(build: Callable[[Inputs], DataFrame], **options) -> Query:
    return lambda spark, sf_dir: _portable(build(Inputs(spark, sf_dir, **options)))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue by category over the sales mart."""
    return queries()["revenue_by_category"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return {
        **{name: _bind(build) for name, build in _CORE.items()},
        **{name: _bind(build, variant="lite") for name, build in _LITE.items()},
        **{name: _bind(build, dirty=False) for name, build in _CLEAN.items()},
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The DuckDB statement for each registered query that SQL can express."""
    statements = {**oracle_queries.build(), **(llm.oracle_sql() if llm else {})}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
