"""Frame profiles as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and missing values, in one pass."""
    counts = df.agg(
        *(
            F.count_if(F.col(f"`{name}`").isNull()).alias(f"c{position}")
            for position, name in enumerate(df.columns)
        )
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(position).cast("bigint").alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(f"c{position}").alias("missing"),
            )
            for position, (name, kind) in enumerate(df.dtypes)
        )
    )
    return counts.select(F.inline(entries)).orderBy("position")


def preview(df: DataFrame, *keys: str, rows: int = 3) -> DataFrame:
    """The first rows, by ``keys`` where the order must not depend on the run."""
    return (df.orderBy(*keys) if keys else df).limit(rows)


def summarize(df: DataFrame) -> dict[str, DataFrame]:
    """Shape, column profile and preview of a frame."""
    return {
        "shape": shape(df),
        "columns": column_profile(df),
        "preview": preview(df),
    }
