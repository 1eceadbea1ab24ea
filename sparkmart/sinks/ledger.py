"""Appends that can be run again: a ledger of the batches that a table holds.

A table loaded in batches is partitioned by the batch. A batch counts once the ledger has a
line for it, which is written behind its rows; so

* a batch that is loaded again adds nothing;
* rows of a load that died before its line are dropped by the next load, whichever it is;
* the newest loaded date is read from the ledger, not from the table.

The ledger is a small table beside the loaded ones: one line per batch.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental

LEDGER, BATCH = "load_ledger", "load_batch"
_SCHEMA = "table_name string, batch string, row_count long, newest string, loaded_at timestamp"


def _ledger(table: str) -> str:
    return f"{table.rpartition('.')[0]}.{LEDGER}"


def batches(spark: SparkSession, table: str) -> DataFrame:
    """The ledger's lines for ``table``: batch, row_count, newest, loaded_at."""
    if not spark.catalog.tableExists(_ledger(table)):
        return spark.createDataFrame([], _SCHEMA).drop("table_name")
    lines = spark.table(_ledger(table)).filter(F.col("table_name") == table)
    return lines.drop("table_name")


def rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all batches that count, without the batch column."""
    held = batches(spark, table).select(F.col("batch").alias(BATCH))
    return spark.table(table).join(held, BATCH, "left_semi").drop(BATCH)


def newest(spark: SparkSession, table: str) -> str | None:
    """The newest date of all batches that count, as text."""
    return batches(spark, table).agg(F.max("newest")).first()[0]


def due(
    incoming: DataFrame, table: str, date_column: str, key: str
) -> DataFrame:
    """Incoming rows that ``table`` lacks, from its newest date on; see ``not_loaded``."""
    spark = incoming.sparkSession
    if not spark.catalog.tableExists(table):
        return incoming
    return incremental.not_loaded(
        incoming, rows(spark, table), date_column, key, newest(spark, table)
    )


def append_batch(
    df: DataFrame, table: str, batch: str, date_column: str | None = None
) -> int:
    """Append ``df`` as one batch and return the rows it has; again, it adds nothing.

    Columns are those of the first batch, by position. One table has one writer at a time.
    """
    spark = df.sparkSession
    held = {r.batch: r.row_count for r in batches(spark, table).collect()}
    if batch in held:
        return held[batch]
    marked = df.withColumn(BATCH, F.lit(batch))
    if spark.catalog.tableExists(table):
        for line in spark.sql(f"show partitions {table}").collect():
            found = line.partition.partition("=")[2]
            if found not in held:
                spark.sql(f"alter table {table} drop partition ({BATCH} = '{found}')")
        marked.write.insertInto(table)
    else:
        marked.write.partitionBy(BATCH).saveAsTable(table)
    latest = F.max(date_column) if date_column else F.lit(None)
    n, last = (
        spark.table(table)
        .filter(F.col(BATCH) == batch)
        .agg(F.count("*"), latest.cast("string"))
        .first()
    )
    line = spark.createDataFrame([(table, batch, n, last)], _SCHEMA.rpartition(",")[0])
    line = line.withColumn("loaded_at", F.current_timestamp())
    if spark.catalog.tableExists(_ledger(table)):
        line.write.insertInto(_ledger(table))
    else:
        line.write.saveAsTable(_ledger(table))
    return n
