"""The REST source over ``file:`` URLs; no server is involved."""

from __future__ import annotations

import json
from urllib.request import urlopen

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from sparkmart.plans import pipeline
from sparkmart.sources import rest, star
from sparkmart.sources.delimited import read_csv

USERS = [
    {"id": 1, "name": "Ann", "address": {"city": "X", "geo": {"lat": 1.5}}},
    {"id": 2, "name": "Bob", "address": None},
    {"id": 3, "address": {"city": "Z", "geo": {"lat": None}}, "extra": [1, 2]},
]


@pytest.fixture
def service(tmp_path):
    root = tmp_path / "service"
    root.mkdir()

    def put(name, payload):
        (root / name).write_text(json.dumps(payload), encoding="utf-8")

    put("users", USERS)
    put("posts", [{"userId": 1, "body": "two\nlines, \"quoted\""}])
    put("todos", [{"id": i, "completed": i % 2 == 0} for i in range(5)])
    put("page2", [{"id": i, "completed": False} for i in range(5, 8)])
    put("none", [])
    put("object", {"id": 1})
    return root.as_uri()


def test_records_and_nested_objects(spark, service, tmp_path):
    df = rest.fetch(spark, service, "/users", str(tmp_path / "land"))
    assert df.columns == ["id", "name", "address", "extra"]
    assert dict(df.dtypes)["address"] == "struct<city:string,geo:struct<lat:double>>"
    rows = {r.id: r for r in df.collect()}
    assert rows[1].address.geo.lat == 1.5
    assert rows[2].address is None and rows[3].name is None
    assert rows[3].extra == [1, 2]


def test_one_partition_per_page(spark, service, tmp_path):
    spark.dataSource.register(rest.RestRecords)
    calls = json.dumps([("t", f"{service}/todos"), ("t", f"{service}/page2")])
    source = spark.read.format(rest.FORMAT).option("calls", calls).load()
    assert source.rdd.getNumPartitions() == 2
    df = rest.fetch(spark, service, ["/todos", "/page2"], str(tmp_path / "land"))
    assert df.count() == 8


def test_empty_array(spark, service, tmp_path):
    df = rest.fetch(spark, service, "/none", str(tmp_path / "land"))
    assert df.columns == [] and df.count() == 0


@pytest.mark.parametrize("endpoint", ["/absent", "/object"])
def test_errors_raise(spark, service, tmp_path, endpoint):
    with pytest.raises(PySparkException):
        rest.fetch(spark, service, endpoint, str(tmp_path / "land"))


def test_http_error_status_raises(monkeypatch):
    from urllib.error import HTTPError

    def refuse(request, timeout):
        raise HTTPError(request.full_url, 503, "unavailable", None, None)

    monkeypatch.setattr(rest, "urlopen", refuse)
    reader = rest._RecordReader([("t", "https://service.invalid/x")], 1.0)
    with pytest.raises(HTTPError):
        list(reader.read(reader.partitions()[0]))


def test_api_frames_keep_a_csv_copy(spark, service, tmp_path):
    folder = str(tmp_path / "api")
    frames = pipeline.api_frames(spark, service, folder)
    assert set(frames) == {"api_users", "api_posts", "api_todos"}
    posts = read_csv(spark, f"{folder}/csv/api_posts").collect()
    assert posts[0].body == 'two\nlines, "quoted"'
    users = read_csv(spark, f"{folder}/csv/api_users").filter("id = 1").first()
    assert json.loads(users.address)["geo"] == {"lat": 1.5}


def test_a_fetch_leaves_the_folder_alone(spark, service, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    (folder / "mine.txt").write_text("kept")
    users = rest.fetch(spark, service, "/users", str(folder))
    todos = rest.fetch(spark, service, "/todos", str(folder))
    assert (folder / "mine.txt").read_text() == "kept"
    assert users.count() == 3 and todos.count() == 5


def test_one_empty_endpoint_does_not_stop_the_others(spark, service, tmp_path):
    endpoints = {"a": "/users", "b": "/none", "c": "/todos"}
    with pytest.warns(UserWarning, match="b has no records"):
        frames = pipeline.api_frames(spark, service, str(tmp_path / "x"), endpoints)
    assert set(frames) == {"a", "c"} and frames["c"].count() == 5
    schema = T.StructType([T.StructField("id", T.LongType())])
    frames = pipeline.api_frames(
        spark, service, str(tmp_path / "x"), endpoints, {"b": schema}
    )
    assert frames["b"].schema == schema and frames["b"].count() == 0
    assert frames["a"].count() == 3


def test_many_calls_share_tasks(spark, service, tmp_path):
    def sent(n):
        calls = [["t", f"{service}/todos?page={k}"] for k in range(n)]
        source = rest.RestRecords({"calls": json.dumps(calls)})
        reader = source.reader(source.schema())
        parts = reader.partitions()
        assert [list(c) for p in parts for c in p.calls] == calls
        return len(parts), len(rest.cloudpickle.dumps((source, reader)))

    assert sent(40)[0] == 40
    few, many = sent(64), sent(6400)
    assert few[0] == 64 and many[0] == 200
    assert abs(many[1] - few[1]) < 200  # a task gets no other task's calls
    df = rest.fetch(spark, service, ["/todos", "/page2"] * 100, str(tmp_path / "land"))
    assert df.count() == 800


def test_pages_are_files_of_one_folder(spark, tmp_path):
    records = spark.range(2500).selectExpr("id", "id * 2 as twice")
    pages = star.rest_pages(records, "id", f"file://{tmp_path}/pages")
    assert len({page.rpartition("/")[0] for page in pages}) == 2  # with that of the empty page
    held = [json.loads(urlopen(page).read()) for page in pages]
    assert sorted(len(page) for page in held) == [0, 500, 1000, 1000]
    for page in held:
        assert [r["id"] for r in page] == sorted(r["id"] for r in page)
        assert len({r["id"] // 1000 for r in page}) <= 1
    assert sorted(r["twice"] for page in held for r in page) == list(range(0, 5000, 2))
