"""Frame cleaning: empty rows, headers, whitespace, duplicates, types.

Steps run in a fixed order: rows of NULLs go first, then headers and text are
normalised, then duplicates go. A row of blanks is therefore kept (as ``""``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalised_headers, strip_all


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.na.drop(how="all")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename columns to lower snake case; a collision raises."""
    return df.toDF(*normalised_headers(df.columns))


def strip_text(df: DataFrame) -> DataFrame:
    """Strip all whitespace around every top-level text column."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: strip_all(F.col(f"`{name}`")) for name in text})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; NULL equals NULL."""
    return df.dropDuplicates()


def clean(df: DataFrame) -> DataFrame:
    """All cleaning steps in order."""
    return drop_duplicates(strip_text(normalise_headers(drop_empty(df))))


def clean_report(df: DataFrame) -> DataFrame:
    """What :func:`clean` does to ``df``, in one row and one pass.

    Computed as an ordinary aggregate and not from task counters, which may
    count twice when a lost executor's tasks run again.
    """
    named = normalise_headers(df)
    empty = F.lit(True)
    for name in named.columns:
        empty = empty & F.col(f"`{name}`").isNull()
    groups = (
        strip_text(named.withColumn("_empty", empty))
        .groupBy(*(f"`{name}`" for name in named.columns), "_empty")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    kept = F.when(~F.col("_empty"), F.col("_rows"))
    rows_in = F.coalesce(F.sum("_rows"), F.lit(0))
    rows_kept = F.coalesce(F.sum(kept), F.lit(0))
    rows_out = F.count(kept)
    return groups.agg(
        rows_in.alias("rows_in"),
        (rows_in - rows_kept).alias("empty_removed"),
        (rows_kept - rows_out).alias("duplicates_removed"),
        rows_out.alias("rows_out"),
        F.lit(len(named.columns)).cast("bigint").alias("columns_out"),
    )


#: What reads as a number: digits with an optional point and exponent, or infinity.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def _holds(column: Column, kind: str) -> Column:
    """Whether no non-NULL text fails to read as ``kind``."""
    if kind == "boolean":
        readable = column.isin("True", "TRUE", "true", "False", "FALSE", "false")
    elif kind == "bigint":
        readable = column.rlike(r"^\s*[+-]?\d+\s*$") & column.try_cast(
            "bigint"
        ).isNotNull()
    else:
        readable = column.rlike(_NUMBER) & F.trim(column).try_cast(kind).isNotNull()
    return F.coalesce(F.bool_and(readable | column.isNull()), F.lit(True))


def infer_types(df: DataFrame) -> DataFrame:
    """Give all-text columns the narrowest of bigint, double, boolean, string.

    One aggregate over the frame, from which a single row of flags reaches the
    driver. A column without any value becomes double.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    kinds = ("bigint", "double", "boolean")
    flags = df.agg(
        *(
            _holds(F.col(f"`{name}`"), kind).alias(f"{kind}:{position}")
            for position, name in enumerate(text)
            for kind in kinds
        ),
        *(
            F.count(f"`{name}`").alias(f"values:{position}")
            for position, name in enumerate(text)
        ),
    ).first()
    casts = {}
    for position, name in enumerate(text):
        if flags[f"values:{position}"] == 0:
            kind = "double"
        else:
            kind = next((k for k in kinds if flags[f"{k}:{position}"]), None)
        if kind:
            casts[name] = F.trim(F.col(f"`{name}`")).cast(kind)
    return df.withColumns(casts)
