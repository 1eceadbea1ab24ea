"""CSV output, and frames stored for reading again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def write_csv(df: DataFrame, folder: str, sep: str = ",") -> None:
    """Write with a header and without an index; nested columns as JSON text."""
    nested = {
        f.name: F.to_json(f"`{f.name}`")
        for f in df.schema
        if isinstance(f.dataType, _NESTED)
    }
    (
        df.withColumns(nested)
        .write.mode("overwrite")
        .options(
            header=True,
            sep=sep,
            quote='"',
            escape='"',
            encoding="UTF-8",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(folder)
    )


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage in a way that outlives executors, and unlike a checkpoint
    leaves columns that can be read one by one.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    if partition_by:
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return df.sparkSession.read.parquet(path)
