"""Reading the input tables, and tables that cut a plan's lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import fresh_path

#: Rows (of a few numbers each) that are broadcast; a larger side is shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame's rows as a table in the shared folder, computed once.

    Every reader of the table sees the same rows, also after an executor is lost.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, names: list[str] | None = None) -> Column:
    """A row's columns (all, or those named) as one column ``row``.

    Whatever they are called, they clash with no other; ``select("row.*")`` unpacks them.
    """
    return F.struct(*(F.col(f"`{c}`") for c in names or df.columns)).alias("row")


def bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, and unchanged if not; counts them."""
    few = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if few else df
