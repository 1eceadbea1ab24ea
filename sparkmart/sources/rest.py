"""Record arrays behind REST endpoints.

One Spark partition per request (an endpoint or one page of it), or per run of
requests where there are many. The fetched records are landed as JSON lines before anything reads them: a task that runs
again after an executor was lost must not see a different answer from the
service half-way through a job.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Mapping, Sequence
from urllib.request import Request, urlopen

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "rest_records"
#: A partition makes up to ``CALLS`` requests one after another, as long as there are
#: ``SPREAD`` partitions; its records are never held beyond one response.
CALLS, SPREAD = 32, 64

# Workers get the data source by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Calls(InputPartition):
    def __init__(self, calls: Sequence[tuple[str, str]]):
        super().__init__(calls)
        self.calls = calls


class _RecordReader(DataSourceReader):
    def __init__(self, calls: Sequence[tuple[str, str]], timeout: float):
        self.calls = calls
        self.timeout = timeout

    def __getstate__(self) -> dict:
        # The reader goes to every task, which needs the calls of its partition alone.
        return self.__dict__ | {"calls": ()}

    def partitions(self) -> Sequence[InputPartition]:
        size = max(1, min(CALLS, len(self.calls) // SPREAD))
        return [
            _Calls(self.calls[k : k + size]) for k in range(0, len(self.calls), size)
        ]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        for table, url in partition.calls:
            for record in self._records(url):
                yield table, json.dumps(record, ensure_ascii=False)

    def _records(self, url: str) -> list:
        request = Request(url, headers={"Accept": "application/json"})
        # urlopen raises on an HTTP error status, which fails the task.
        with urlopen(request, timeout=self.timeout) as response:
            payload = json.load(response)
        if not isinstance(payload, list):
            raise ValueError(f"{url} did not return an array of records")
        return payload


class RestRecords(DataSource):
    """``(table, record)`` rows; ``record`` is one element as a JSON text."""

    planned = False

    def __getstate__(self) -> dict:
        # Spark sends the source to every task along with its reader.
        return self.__dict__ | ({"options": {}} if self.planned else {})

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "table string, record string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        calls = [tuple(call) for call in json.loads(self.options["calls"])]
        self.planned = True
        return _RecordReader(calls, float(self.options.get("timeout", "60")))


def land(
    spark: SparkSession,
    base_url: str,
    endpoints: Mapping[str, str | Sequence[str]],
    folder: str,
    timeout: float = 60,
) -> str:
    """Fetch ``{table: endpoint or pages}`` into ``folder`` as JSON lines.

    Each call makes a subfolder of its own there and returns it, so nothing that is
    in ``folder`` is touched and frames of earlier calls stay readable.
    """
    calls = [
        (table, f"{base_url}{page}")
        for table, pages in endpoints.items()
        for page in ([pages] if isinstance(pages, str) else pages)
    ]
    spark.dataSource.register(RestRecords)
    landed = f"{folder.rstrip('/')}/fetch-{uuid.uuid4().hex}"
    (
        spark.read.format(FORMAT)
        .option("calls", json.dumps(calls))
        .option("timeout", timeout)
        .load()
        .write.partitionBy("table")
        .text(landed)
    )
    return landed


def read_landed(
    spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """One landed table, its schema inferred; nested objects become structs.

    Columns come in the order of the first record's keys. A table whose endpoint
    returned no record has the columns of ``schema``, or none if that is not given.
    """
    path = f"{folder}/table={table}"
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema or T.StructType([]))
        raise
    rows = spark.read.json(path)
    first = lines.select(F.json_object_keys("value")).first()
    leading = [name for name in (first[0] or []) if name in rows.columns]
    return rows.select(
        *(f"`{n}`" for n in leading + [n for n in rows.columns if n not in leading])
    )


def fetch(
    spark: SparkSession, base_url: str, endpoint: str | Sequence[str], folder: str
) -> DataFrame:
    """Fetch one endpoint (or its pages) through ``folder``."""
    landed = land(spark, base_url, {"records": endpoint}, folder)
    return read_landed(spark, landed, "records")
