"""Option building of the JDBC source; no database is started for tests."""

from __future__ import annotations

import duckdb
import pytest

from sparkmart.plans import pipeline
from sparkmart.sources import jdbc


class Recorder:
    """Stands in for ``spark.read``/``df.write`` and keeps what it was told."""

    def __init__(self, first=None):
        self.calls = []
        self.options_seen = []
        self._first = first

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self

    @property
    def sparkSession(self):
        return self

    def format(self, name):
        self.calls.append(name)
        return self

    def mode(self, name):
        self.calls.append(name)
        return self

    def options(self, **given):
        self.options_seen.append(given)
        return self

    def load(self):
        return self

    def save(self):
        self.calls.append("save")

    def first(self):
        return self._first

    def count(self):
        return 7

    def repartition(self, number):
        self.calls.append(f"repartition {number}")
        return self


@pytest.fixture(autouse=True)
def nothing_is_stored(monkeypatch):
    monkeypatch.setattr(jdbc, "stored", lambda df, label: df)


URL = "jdbc:any:thing"


def test_split_options():
    assert jdbc.split_options("id", 1, 100, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "4",
    }
    assert jdbc.split_options("id", None, None, 4) == {}
    assert jdbc.split_options("id", 1, 100, 1) == {}


def test_whole_table_and_query():
    source = Recorder()
    jdbc.read_table(source, URL, "orders", {"user": "u"})
    jdbc.read_query(source, URL, "select 1")
    assert source.options_seen == [
        {"fetchsize": "10000", "user": "u", "url": URL, "dbtable": "orders"},
        {"fetchsize": "10000", "url": URL, "query": "select 1"},
    ]


def test_fetch_size_can_be_set():
    source = Recorder()
    jdbc.read_table(source, URL, "orders", {"fetchsize": "5"})
    assert source.options_seen[0]["fetchsize"] == "5"


def test_shop_tables_are_read_in_parallel_by_default():
    source = Recorder(first=(1, 9))
    pipeline.db_frames(source, URL)
    counts = {o["numPartitions"] for o in source.options_seen if "dbtable" in o}
    assert counts == {str(jdbc.PARTITIONS)}


def test_parallel_read_asks_for_bounds_first():
    source = Recorder(first=(5, 50))
    jdbc.read_table(source, URL, "orders", split_column="order_id", partitions=3)
    bounds, table = source.options_seen
    assert "min(order_id)" in bounds["query"] and "max(order_id)" in bounds["query"]
    assert (table["lowerBound"], table["upperBound"]) == ("5", "50")


def test_shop_tables_are_split_by_their_keys():
    source = Recorder(first=(1, 9))
    frames = pipeline.db_frames(source, URL, partitions=2)
    assert list(frames) == ["customers", "products", "orders"]
    keys = [o["partitionColumn"] for o in source.options_seen if "dbtable" in o]
    assert keys == ["customer_id", "product_id", "order_id"]


def test_write_compares_counts():
    sink = Recorder(first=(7,))
    assert jdbc.write_table(sink, URL, "orders") == 7
    assert sink.calls[:4] == ["repartition 8", "jdbc", "overwrite", "save"]
    lossy = Recorder(first=(8,))
    try:
        jdbc.write_table(lossy, URL, "orders")
    except RuntimeError as error:
        assert "8 rows, expected 7" in str(error)
    else:
        raise AssertionError("a wrong count must raise")


class Counting(Recorder):
    """Answers the counting queries as a database would, and keeps the predicates."""

    def __init__(self, keys):
        super().__init__()
        self.db = duckdb.connect()
        self.db.execute("create table orders (id bigint)")
        self.db.executemany("insert into orders values (?)", [(k,) for k in keys])

    def collect(self):
        return self.db.execute(self.options_seen[-1]["query"]).fetchall()

    def jdbc(self, url, table, predicates, properties):
        self.predicates, self.properties = predicates, properties
        return self

    def rows(self):
        sql = "select count(*) from orders where "
        return [self.db.execute(sql + p).fetchone()[0] for p in self.predicates]


KEYS = {
    "dense": list(range(1, 2001)),
    "far apart": [k * 10**14 for k in range(1000)],
    "in clusters": [*range(900), *range(10**12, 10**12 + 900), 9 * 10**17],
    "negative": list(range(-500, 500)),
    "one heavy key": [5] * 900 + list(range(100)),
    "one key": [7] * 10,
    "with NULLs": [*range(1000), *[None] * 300],
}


@pytest.mark.parametrize("name", KEYS)
def test_ranges_hold_equal_rows(monkeypatch, name):
    monkeypatch.setattr(jdbc, "SLOTS", 64)
    keys = KEYS[name]
    source = Counting(keys)
    jdbc.read_evenly(source, URL, "orders", "id", {"user": "u"}, partitions=8)
    assert source.properties == {"fetchsize": "10000", "user": "u"}
    rows = source.rows()
    assert sum(rows) == len(keys) and len(rows) <= 9
    assert source.predicates[-1] == "id is null" and rows[-1] == keys.count(None)
    # Twice the fair share, but for a key that has more by itself.
    whole = [k for k in keys if k is not None]
    heaviest = max(whole.count(k) for k in set(whole))
    assert max(rows[:-1]) <= max(2 * len(whole) / 8, heaviest + len(whole) / 8)
    assert len(source.options_seen) < 60


def test_ranges_of_an_empty_table():
    source = Counting([None, None])
    jdbc.read_evenly(source, URL, "orders", "id")
    assert source.predicates == ["id is not null", "id is null"]
    assert source.rows() == [0, 2]
