"""Loading raw tables, building the models and testing them, in order."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import quality
from ..schemas import MARTS, RAW, STAGING
from ..sinks import files, tables
from ..sources import jdbc, rest
from . import marts, reports, staging

# The tables loaded from the REST service and their endpoints.
API_ENDPOINTS = {"api_users": "/users", "api_posts": "/posts", "api_todos": "/todos"}
DB_TABLES = ("customers", "products", "orders")
SALES_PARTITIONS = ("order_year", "order_month")


@dataclass(frozen=True)
class Layers:
    """Names of the three schemas."""

    raw: str = RAW
    staging: str = STAGING
    marts: str = MARTS

    @property
    def all(self) -> tuple[str, str, str]:
        return self.raw, self.staging, self.marts


@dataclass(frozen=True)
class LoadReport:
    rows: Mapping[str, int]
    contents: DataFrame
    summary: DataFrame


def load_raw(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    layers: Layers = Layers(),
    mode: str = "replace",
) -> dict[str, int]:
    """Load each frame into its raw table; returns the row counts."""
    return {
        name: tables.load_table(frame, f"{layers.raw}.{name}", mode)
        for name, frame in frames.items()
    }


def api_frames(
    spark: SparkSession,
    base_url: str,
    folder: str,
    endpoints: Mapping[str, str | Sequence[str]] = API_ENDPOINTS,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Fetch the endpoints, keep a CSV copy of each, and return the frames.

    An endpoint that returns no record is an empty table of its ``schemas`` entry. If
    it has none, it is left out with a warning, and the others are returned.
    """
    landed = rest.land(spark, base_url, endpoints, f"{folder}/landed")
    frames = {}
    for name in endpoints:
        frame = rest.read_landed(spark, landed, name, (schemas or {}).get(name))
        if frame.columns:
            files.write_csv(frame, f"{folder}/csv/{name}")
            frames[name] = frame
        else:
            warnings.warn(f"{name} has no records and no schema", stacklevel=2)
    return frames


def db_frames(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    names: Sequence[str] = DB_TABLES,
    partitions: int = jdbc.PARTITIONS,
    even: bool = False,
) -> dict[str, DataFrame]:
    """The shop tables of a JDBC database, each read in ranges of its key.

    ``even`` counts rows first, for keys with gaps or clusters.
    """
    frames = {}
    for name in names:
        key = f"{name.removesuffix('s')}_id"
        if even:
            frames[name] = jdbc.read_evenly(spark, url, name, key, properties, partitions)
        else:
            frames[name] = jdbc.read_table(spark, url, name, properties, key, partitions)
    return frames


def build_staging(
    spark: SparkSession,
    layers: Layers = Layers(),
    variant: str = "core",
    as_of: date | str | None = None,
) -> None:
    """Create the staging views over the raw tables."""
    for name in staging.STAGING_MODELS:
        spark.sql(
            staging.model(name, variant).view_sql(layers.raw, layers.staging, as_of)
        )


def build_marts(
    spark: SparkSession, layers: Layers = Layers(), variant: str = "core"
) -> None:
    """Write the mart tables from the staging views."""
    orders, customers, products = (
        spark.table(f"{layers.staging}.{name}") for name in staging.STAGING_MODELS
    )
    tables.replace_table(
        marts.mart_sales(orders, customers, products, variant),
        f"{layers.marts}.mart_sales",
        partition_by=SALES_PARTITIONS,
    )
    tables.replace_table(
        marts.mart_customers(orders, customers, variant),
        f"{layers.marts}.mart_customers",
    )


def build_models(
    spark: SparkSession,
    layers: Layers = Layers(),
    variant: str = "core",
    as_of: date | str | None = None,
) -> None:
    """Staging views, then marts."""
    build_staging(spark, layers, variant, as_of)
    build_marts(spark, layers, variant)


def check_models(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    """Run the data-quality suite over the built (core) models."""
    models = {
        **{n: spark.table(f"{layers.staging}.{n}") for n in staging.STAGING_MODELS},
        **{
            n: spark.table(f"{layers.marts}.{n}")
            for n in ("mart_sales", "mart_customers")
        },
    }
    return quality.run(models)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Any SQL over the warehouse; ``{name}`` in it stands for a given frame."""
    return spark.sql(sql, **frames)


def run_full_load(
    spark: SparkSession,
    db_frames: Mapping[str, DataFrame],
    api: Mapping[str, DataFrame] | None = None,
    layers: Layers = Layers(),
    location: str | None = None,
) -> LoadReport:
    """Load API and database tables, list the warehouse, run the sample report."""
    tables.create_schemas(spark, layers.all, location)
    rows = load_raw(spark, {**(api or {}), **db_frames}, layers)
    return LoadReport(
        rows=rows,
        contents=tables.list_tables(spark, layers.all),
        summary=reports.raw_category_summary(
            spark.table(f"{layers.raw}.orders"), spark.table(f"{layers.raw}.products")
        ),
    )
