"""Tables and queries of a JDBC database.

Column pruning and simple filters reach the database by themselves, so an
incremental extract is ``since(read_table(...), column, date)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import since
from ..sinks.files import stored

#: Ranges that a table is read in, and rows fetched by one round trip.
PARTITIONS = 16
FETCH_SIZE = 10_000
#: Slots of keys that rows are counted in to find even ranges.
SLOTS = 1024


def split_options(
    column: str, lowest: object, highest: object, partitions: int
) -> dict[str, str]:
    """Options that make Spark read a table in ranges of ``column``."""
    if lowest is None or partitions < 2:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lowest),
        "upperBound": str(highest),
        "numPartitions": str(partitions),
    }


def read_query(
    spark: SparkSession,
    url: str,
    sql: str,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The result of any query the database understands."""
    return (
        spark.read.format("jdbc")
        .options(
            **{"fetchsize": str(FETCH_SIZE), **(properties or {}), "url": url, "query": sql}
        )
        .load()
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_column: str | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """A whole table, read in parallel ranges when ``split_column`` is given.

    Without it the table comes over one connection into one task.
    """
    options = {
        "fetchsize": str(FETCH_SIZE),
        **(properties or {}),
        "url": url,
        "dbtable": table,
    }
    if split_column and partitions > 1:
        lowest, highest = read_query(
            spark,
            url,
            f"select min({split_column}) as lo, max({split_column}) as hi from {table}",
            properties,
        ).first()
        options |= split_options(split_column, lowest, highest, partitions)
    return spark.read.format("jdbc").options(**options).load()


def _histogram_sql(table: str, column: str, low: int, high: int, width: int) -> str:
    """Rows by the first key of each slot of ``width`` keys, of those from low to high."""
    slot = f"{column} - (({column} - {low}) % {width})"
    return (
        f"select {slot} as slot, count(*) as n from {table} "
        f"where {column} >= {low} and {column} <= {high} group by {slot}"
    )


def _histogram(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    properties: Mapping[str, str] | None,
    partitions: int,
) -> list[tuple[int, int, int]]:
    """(first key, last key, rows) of slots that cover all whole-number keys, in order.

    Slots with more rows than a partition should have are counted again in narrower ones, until
    they are small or hold one key; at most ``partitions`` slots can be so large at once.
    """

    def rows_of(sql: str) -> list:
        return read_query(spark, url, sql, properties).collect()

    lowest, highest = rows_of(
        f"select min({column}) as lo, max({column}) as hi from {table}"
    )[0]
    if lowest is None:
        return []
    due, done, most = [(int(lowest), int(highest))], [], None
    while due:
        large = []
        for low, high in due:
            width = max(1, -(-(high - low + 1) // SLOTS))
            found = rows_of(_histogram_sql(table, column, low, high, width))
            slots = sorted((int(r[0]), int(r[1])) for r in found)
            if most is None:
                most = max(1, sum(n for _, n in slots) // partitions)
            for start, n in slots:
                end = min(start + width - 1, high)
                if n > most and width > 1:
                    large.append((start, end))
                else:
                    done.append((start, end, n))
        due = large
    return sorted(done)


def even_ranges(slots: list[tuple[int, int, int]], partitions: int) -> list[tuple[int, int]]:
    """Neighbouring slots put together to at most ``partitions`` ranges of about equal rows."""
    total, taken, ranges = sum(n for _, _, n in slots), 0, []
    for low, high, n in slots:
        share = taken * partitions // total if total else 0
        if ranges and ranges[-1][2] == share:
            ranges[-1] = (ranges[-1][0], high, share)
        else:
            ranges.append((low, high, share))
        taken += n
    return [(low, high) for low, high, _ in ranges]


def predicates(column: str, ranges: list[tuple[int, int]]) -> list[str]:
    """Conditions of which every row meets one; keys that are NULL have one of their own.

    The outer ranges are open, so rows that come in meanwhile have a place, too.
    """
    cuts = [low for low, _ in ranges[1:]]
    if not cuts:
        return [f"{column} is not null", f"{column} is null"]
    inner = [
        f"{column} >= {low} and {column} < {high}"
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]
    return [f"{column} < {cuts[0]}", *inner, f"{column} >= {cuts[-1]}", f"{column} is null"]


def read_evenly(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    properties: Mapping[str, str] | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """A whole table, in ranges of its whole-number ``key`` that hold about equal rows.

    For keys with gaps or clusters, where ranges of equal width would put most rows into a
    few tasks. The database counts the rows per slot of keys, a few scans of the key's
    index; only these counts come to the driver, some thousands at most.
    """
    slots = _histogram(spark, url, table, key, properties, partitions)
    return spark.read.jdbc(
        url,
        table,
        predicates=predicates(key, even_ranges(slots, partitions)),
        properties={"fetchsize": str(FETCH_SIZE), **(properties or {})},
    )


def read_incremental(
    spark: SparkSession,
    url: str,
    table: str,
    date_column: str,
    first_date: date | str,
    properties: Mapping[str, str] | None = None,
    **split,
) -> DataFrame:
    """Rows of a table on or after a date; the comparison runs in the database."""
    source = read_table(spark, url, table, properties, **split)
    return since(source, date_column, first_date)


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> int:
    """Replace a database table; returns the rows it holds afterwards.

    A task commits its rows in one transaction, but a task whose executor is lost
    right after the commit runs again. The count taken in the database is
    therefore compared with the frame's and a difference raises. The frame is stored
    first: its plan runs once, with its own parallelism, whatever the ``connections``.
    """
    rows = stored(df, "jdbc")
    (
        rows.repartition(connections).write.format("jdbc")
        .mode("overwrite")
        .options(
            **{
                **(properties or {}),
                "url": url,
                "dbtable": table,
                "numPartitions": str(connections),
            }
        )
        .save()
    )
    held = read_query(
        df.sparkSession, url, f"select count(*) as n from {table}", properties
    ).first()[0]
    wanted = rows.count()
    if held != wanted:
        raise RuntimeError(f"{table} holds {held} rows, expected {wanted}")
    return int(held)
