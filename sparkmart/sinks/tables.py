"""Catalog schemas, tables and views."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MODES = ("replace", "append")
#: Endings of the names that a table's versions have while it is replaced, and what marks
#: the folder of a version.
_NEW, _OLD, _VERSION = "__new_", "__old", "__version_"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_schemas(
    spark: SparkSession, schemas: Sequence[str], location: str | None = None
) -> None:
    """Create the schemas that are missing, under ``location`` when given."""
    for schema in schemas:
        place = f" location '{location}/{schema}'" if location else ""
        spark.sql(f"create schema if not exists {_quoted(schema)}{place}")


def drop_schemas(spark: SparkSession, schemas: Sequence[str]) -> None:
    """Drop schemas with all their tables and views."""
    for schema in schemas:
        spark.sql(f"drop schema if exists {_quoted(schema)} cascade")


def _parts(spark: SparkSession, table: str) -> tuple[str, str]:
    schema, _, name = table.replace("`", "").rpartition(".")
    return schema or spark.catalog.currentDatabase(), name


def _full(schema: str, name: str) -> str:
    return f"{_quoted(schema)}.{_quoted(name)}"


def _rename(spark: SparkSession, schema: str, name: str, new: str) -> None:
    spark.sql(f"alter table {_full(schema, name)} rename to {_full(schema, new)}")


def _drop_version(spark: SparkSession, schema: str, name: str) -> None:
    """Drop a version of a table with its files, which the catalog leaves alone."""
    told = spark.sql(f"describe extended {_full(schema, name)}").collect()
    place = next(r.data_type for r in told if r.col_name == "Location")
    spark.sql(f"drop table {_full(schema, name)}")
    if _VERSION in place:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo what a replacement that was cut off has left: the last whole version counts."""
    schema, name = _parts(spark, table)
    if not spark.catalog.databaseExists(schema):
        return
    left = [
        entry.name
        for entry in spark.catalog.listTables(schema, f"{name}__*")
        if entry.name == name + _OLD or entry.name.startswith(name + _NEW)
    ]
    if name + _OLD in left and not spark.catalog.tableExists(_full(schema, name)):
        _rename(spark, schema, name + _OLD, name)
        left.remove(name + _OLD)
    for version in left:
        _drop_version(spark, schema, version)


def replace_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), **options: str
) -> None:
    """Replace a table by the rows of ``df``, which may read that table.

    The rows are written beside the table, to a folder of their own; only then do names
    change, which moves no data: the table becomes the old version, the new one the table.
    Until then readers see the old rows, and so they do for good if the write fails. A
    driver that dies between the two changes of name leaves the old version, which
    :func:`recover_table` (called here first) puts back. One table has one writer at a time.

    With ``partition_by`` rows of a partition are brought together before the write; a
    partition too large for one task is split again. ``options`` stay with the table.
    """
    spark = df.sparkSession
    schema, name = _parts(spark, table)
    recover_table(spark, table)
    mark = uuid.uuid4().hex
    new = f"{name}{_NEW}{mark}"
    home = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    place = f"{home}/{name}{_VERSION}{mark}"
    writer = rows.write.format("parquet").options(path=place, **options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(_full(schema, new))
        held = spark.catalog.tableExists(_full(schema, name))
        if held:
            _rename(spark, schema, name, name + _OLD)
        _rename(spark, schema, new, name)
    except Exception:
        recover_table(spark, table)
        raise
    if held:
        _drop_version(spark, schema, name + _OLD)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a table; columns are taken by position, not by name."""
    df.write.insertInto(table)


def load_table(df: DataFrame, table: str, mode: str = "replace") -> int:
    """Load a frame into a table and return the rows the table then holds."""
    if mode == "replace":
        replace_table(df, table)
    elif mode == "append":
        append_table(df, table)
    else:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return row_count(df.sparkSession, table)


def row_count(spark: SparkSession, table: str) -> int:
    """Rows in a table; for Parquet this reads file footers only."""
    return spark.table(table).count()


def list_tables(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """Tables and views of the given schemas, sorted.

    ``same_name_tables`` counts the catalog entries of any schema that carry the
    same name. It is not a row count; :func:`row_count` is.
    """
    wanted = set(schemas)
    own = [
        (name, entry.name)
        for name in schemas
        for entry in spark.catalog.listTables(name)
        if not entry.isTemporary
    ]
    same = Counter(name for _, name in own)
    # Elsewhere only entries that carry one of these names are asked for.
    pattern = "|".join(sorted(same))
    for database in spark.catalog.listDatabases() if same else ():
        if database.name not in wanted:
            for entry in spark.catalog.listTables(database.name, pattern):
                if not entry.isTemporary:
                    same[entry.name] += 1
    rows = [(schema, name, same[name]) for schema, name in own]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, same_name_tables long"
    ).orderBy("table_schema", "table_name")
