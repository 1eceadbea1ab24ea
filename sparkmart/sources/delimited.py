"""CSV files as all-text frames, with the missing-value and bad-line rules.

* a line with more fields than the header is skipped, a shorter one is padded
  with NULL;
* texts such as ``NA`` or ``null`` are missing values;
* a quoted field may contain line breaks;
* bytes that are not UTF-8 raise, and the file is named.

Everything stays in the JVM. Spark marks lines of the wrong length as corrupt;
to tell "too long" from "too short" the line is parsed once more with an end
mark appended. In a short line the mark lands inside the declared columns, in a
long one behind them.
"""

from __future__ import annotations

import csv
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_missing, file_headers, header_name
from ..operators.cleaning import clean, infer_types
from ..sinks.files import stored

#: So many different first lines are no longer looked at one by one.
_HEADERS = 100
_CORRUPT = "_corrupt_record"
_END_MARK = "\x01end of line\x01"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV file not found: {path}") from error
        raise


class _Catalog(NamedTuple):
    """What one pass over the lines of all files tells."""

    headers: list[tuple[str, str]]  # a first line that is not blank, and a file that has it
    files: int  # files that have a line at all
    open: list[str]  # files (as Spark names them) in which a field may go on behind a line


def _catalog(lines: DataFrame, path: str) -> _Catalog:
    """Headers, files with open quotes, and a check that all bytes are UTF-8.

    A field may go on where a line has an odd number of quotes; only the file that has
    such a line can't be split. What is known of each file is stored once and put together in the
    cluster: the driver gets the different headers (two are enough to raise), and
    the names of the files with open quotes alone, which Spark has to be told.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = stored(
        lines.select(
            F.col("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            (quotes % 2 == 1).alias("open"),
            (~F.is_valid_utf8("value")).alias("bad"),
            (F.trim("value") == "").alias("blank"),
        )
        .groupBy("file")
        .agg(
            F.min_by(
                F.when(~F.col("blank"), F.col("value")),
                F.when(~F.col("blank"), F.struct("block", "at")),
            ).alias("first"),
            F.bool_or("open").alias("open"),
            F.count_if("bad").alias("bad"),
        ),
        "csv",
    )
    wrong = files.filter("bad > 0").orderBy("file").limit(1).collect()
    if wrong:
        raise ValueError(
            f"{unquote(wrong[0].file)} is not UTF-8: {wrong[0].bad} lines hold other bytes"
        )
    files = files.filter("first is not null")
    headers = (
        files.groupBy("first")
        .agg(F.min("file").alias("file"), F.count("*").alias("n"))
        .orderBy("file")
        .limit(_HEADERS)
        .collect()
    )
    # Different first lines may be one header, spelled with and without quotes.
    if len(headers) == _HEADERS:
        raise ValueError(f"files in {path} have differing headers")
    opened = files.filter("open").select("file").orderBy("file").collect()
    return _Catalog(
        [(r.first, unquote(r.file)) for r in headers],
        sum(r.n for r in headers),
        [r.file for r in opened],
    )


def _header(spark: SparkSession, found: _Catalog, sep: str) -> list[str]:
    """The header that all files share; differing ones raise."""
    headers = []
    for first, path in found.headers:
        if first.count('"') % 2 == 0:
            headers.append(next(csv.reader([first], delimiter=sep)))
        else:  # the header goes on behind its first line
            reader = spark.read.options(sep=sep, quote='"', escape='"', multiLine=True)
            headers.append([field or "" for field in reader.csv(path).first()])
    for other in headers[1:]:
        if other != headers[0]:
            raise ValueError(f"files have differing headers: {headers[0]} and {other}")
    return file_headers(headers[0])


def _too_long(width: int, sep: str) -> Column:
    slots = ", ".join(f"c{i} string" for i in range(width))
    marked = F.concat(F.rtrim(F.col(_CORRUPT), F.lit("\r\n")), F.lit(sep + _END_MARK))
    parsed = F.from_csv(marked, slots, {"sep": sep, "quote": '"', "escape": '"'})
    fields = F.array(*(parsed[f"c{i}"] for i in range(width)))
    return F.coalesce(~F.exists(fields, lambda f: f.eqNullSafe(_END_MARK)), F.lit(True))


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multi_line: bool | None = None,
) -> DataFrame:
    """Read CSV files that share one header; all columns are text.

    A file with line breaks inside fields cannot be split over tasks. When
    ``multi_line`` is not given, one pass over the lines finds the files in which a
    field may continue on the next line; all others are split. Files whose headers
    differ raise.
    """
    found = _catalog(_lines(spark, path), path)
    if not found.files:
        raise ValueError(f"no columns to read in {path}")
    names = _header(spark, found, sep)
    slots = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(s, T.StringType()) for s in slots + [_CORRUPT]])

    def scan(whole: bool, paths: str | list[str]) -> DataFrame:
        return (
            spark.read.schema(schema)
            .options(
                header=True,
                sep=sep,
                quote='"',
                escape='"',
                encoding="UTF-8",
                mode="PERMISSIVE",
                columnNameOfCorruptRecord=_CORRUPT,
                # Pruned columns would hide lines of the wrong length.
                columnPruning=False,
                multiLine=whole,
            )
            .csv(paths)
        )

    columns = slots + [_CORRUPT]
    if multi_line is not None or len(found.open) in (0, found.files):
        whole = bool(found.open) if multi_line is None else multi_line
        rows = scan(whole, path).select(*columns)
    else:
        # Spark leaves files out by this column before it reads them.
        split = ~F.col("_metadata.file_path").isin(found.open)
        rows = scan(True, [unquote(f) for f in found.open]).select(*columns).union(
            scan(False, path).filter(split).select(*columns)
        )
    # The last term is never true; Spark refuses a scan (such as for a count) that
    # would need the corrupt-record column alone.
    fits = (
        F.col(_CORRUPT).isNull()
        | ~_too_long(len(names), sep)
        | F.col(slots[0]).eqNullSafe(_END_MARK)
    )
    return rows.filter(fits).select(
        *(blank_missing(F.col(s)).alias(n) for s, n in zip(slots, names))
    )


def declared_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the types declared for their cleaned names."""
    kinds = {field.name: field.dataType for field in schema}
    return df.select(
        *(
            F.col(f"`{name}`").cast(kinds.get(header_name(name), "string")).alias(name)
            for name in df.columns
        )
    )


def load_and_clean(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options
) -> DataFrame:
    """Read CSV files, give columns their types and clean the rows.

    Types are those of ``schema``, or found by one more pass when none is given.
    They come first, so that duplicates are found among values and not among
    their spellings (``1`` and ``1.0`` in one column are equal).
    """
    rows = read_csv(spark, path, **options)
    return clean(declared_types(rows, schema) if schema else infer_types(rows))
