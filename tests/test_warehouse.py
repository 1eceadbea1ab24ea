from __future__ import annotations

import os
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkmart.operators import incremental
from sparkmart.plans import monthly, pipeline, staging
from sparkmart.session import fresh_path
from sparkmart.sinks import ledger, tables

from . import frames as f


@pytest.fixture
def layers(spark):
    mark = uuid.uuid4().hex[:8]
    made = pipeline.Layers(f"raw_{mark}", f"staging_{mark}", f"marts_{mark}")
    tables.create_schemas(spark, made.all)
    return made


@pytest.fixture
def shop(spark):
    return {
        "customers": f.customers(spark, f.customer(1), f.customer(2, name=None)),
        "products": f.products(spark, f.product(1), f.product(2, category="Home")),
        "orders": f.orders(
            spark,
            f.order(1),
            f.order(2, customer_id=2, product_id=2, amount=30.0, day="2001-06-01"),
            f.order(3, status="pending"),
        ),
    }


def test_replace_and_append(spark, layers):
    table = f"{layers.raw}.t"
    df = spark.createDataFrame([(1, 2)], "x int, y int")
    assert tables.load_table(df, table) == 1
    assert tables.load_table(df, table) == 1
    # By position: y goes into x.
    swapped = spark.createDataFrame([(30, 40)], "y int, x int")
    assert tables.load_table(swapped, table, "append") == 2
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, 2), (30, 40)]
    with pytest.raises(PySparkException):
        tables.append_table(spark.createDataFrame([("a", 1)], "x string, y int"), table)
    with pytest.raises(ValueError):
        tables.load_table(df, table, "upsert")


def test_replace_by_rows_of_the_same_table(spark, layers):
    table = f"{layers.raw}.t"
    tables.load_table(spark.range(10), table)
    assert tables.load_table(spark.table(table).filter("id < 4"), table) == 4
    assert tables.load_table(spark.table(table).filter("id < 2"), table) == 2


def test_replace_changes_the_schema(spark, layers):
    table = f"{layers.raw}.t"
    tables.load_table(spark.range(3), table)
    tables.load_table(spark.createDataFrame([("a", 1.5)], "s string, d double"), table)
    assert spark.table(table).dtypes == [("s", "string"), ("d", "double")]


def test_models_through_the_catalog(spark, layers, shop):
    assert pipeline.load_raw(spark, shop, layers) == {
        "customers": 2,
        "products": 2,
        "orders": 3,
    }
    pipeline.build_models(spark, layers, as_of="2001-12-31")
    kinds = {t.name: t.tableType for t in spark.catalog.listTables(layers.staging)}
    assert kinds == dict.fromkeys(("stg_orders", "stg_customers", "stg_products"), "VIEW")
    sales = spark.table(f"{layers.marts}.mart_sales")
    assert len(sales.columns) == 23 and sales.count() == 3
    total = pipeline.query(
        spark, f"select sum(completed_revenue) as s from {layers.marts}.mart_sales"
    )
    assert total.first().s == 40
    # A view shows new raw rows at once, a mart only after the next build.
    tables.load_table(
        f.orders(spark, f.order(4)).select(*shop["orders"].columns),
        f"{layers.raw}.orders",
        "append",
    )
    assert spark.table(f"{layers.staging}.stg_orders").count() == 4
    assert spark.table(f"{layers.marts}.mart_sales").count() == 3
    pipeline.build_models(spark, layers, as_of="2001-12-31")
    assert spark.table(f"{layers.marts}.mart_sales").count() == 4

    failed = {
        (r.model, r.column_name, r.test): r.failures
        for r in pipeline.check_models(spark, layers).filter("not passed").collect()
    }
    assert failed == {("mart_sales", "customer_id", "not_null"): 1}


def test_lite_models_through_the_catalog(spark, layers, shop):
    pipeline.load_raw(spark, shop, layers)
    pipeline.build_models(spark, layers, "lite", as_of="2001-12-31")
    assert len(spark.table(f"{layers.marts}.mart_sales").columns) == 20
    assert len(spark.table(f"{layers.marts}.mart_customers").columns) == 12
    assert spark.table(f"{layers.marts}.mart_customers").count() == 2


def test_sales_mart_is_partitioned_by_month(spark, layers, shop):
    pipeline.load_raw(spark, shop, layers)
    pipeline.build_models(spark, layers)
    june = spark.table(f"{layers.marts}.mart_sales").filter(
        "order_year = 2001 and order_month = 6"
    )
    plan = june._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_month" in plan.split("PartitionFilters")[1]
    assert june.count() == 1


def test_listing_counts_names_not_rows(spark, layers, shop):
    pipeline.load_raw(spark, shop, layers)
    spark.range(5).createOrReplaceTempView("orders")
    tables.load_table(spark.range(1), f"{layers.marts}.orders")
    got = [tuple(r) for r in tables.list_tables(spark, layers.all).collect()]
    assert [row[:2] for row in got] == [
        (layers.marts, "orders"),
        (layers.raw, "customers"),
        (layers.raw, "orders"),
        (layers.raw, "products"),
    ]
    counts = {row[:2]: row[2] for row in got}
    assert counts[layers.raw, "orders"] == counts[layers.marts, "orders"] >= 2
    assert tables.row_count(spark, f"{layers.raw}.orders") == 3
    spark.catalog.dropTempView("orders")


def test_full_load(spark, layers, shop):
    api = {"api_todos": spark.createDataFrame([(1, True)], "id int, done boolean")}
    report = pipeline.run_full_load(spark, shop, api, layers)
    assert report.rows == {"api_todos": 1, "customers": 2, "products": 2, "orders": 3}
    assert [r.table_name for r in report.contents.collect()] == [
        "api_todos",
        "customers",
        "orders",
        "products",
    ]
    assert [(r.category, r.total_revenue) for r in report.summary.collect()] == [
        ("Home", 30.0),
        ("Books", 10.0),
    ]


def test_query_takes_frames_by_name(spark):
    df = spark.range(3)
    got = pipeline.query(spark, "select sum(id) as s from {numbers}", numbers=df)
    assert got.first().s == 3


def test_since_is_inclusive(spark):
    df = f.orders(spark, *(f.order(i, day=f"2001-01-0{i}") for i in range(1, 5)))
    got = incremental.since(df, "order_date", "2001-01-03")
    assert sorted(r.order_id for r in got.collect()) == [3, 4]
    recent = incremental.last_days(df, "order_date", 2, as_of="2001-01-04")
    assert sorted(r.order_id for r in recent.collect()) == [2, 3, 4]


def test_not_loaded_skips_rows_of_the_boundary_day(spark):
    held = f.orders(spark, f.order(1, day="2001-01-01"), f.order(2, day="2001-01-02"))
    source = held.unionByName(
        f.orders(spark, f.order(3, day="2001-01-02"), f.order(4, day="2001-01-05"))
    )
    got = incremental.not_loaded(source, held, "order_date", "order_id")
    assert sorted(r.order_id for r in got.collect()) == [3, 4]
    into_empty = incremental.not_loaded(source, held.limit(0), "order_date", "order_id")
    assert into_empty.count() == 4


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(base)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_not_loaded_keeps_rows_without_date_or_key_once(spark):
    kind = "order_id long, order_date string"
    source = spark.createDataFrame(
        [(1, "2001-01-01"), (2, None), (None, "2001-01-02"), (None, None), (3, "2001-01-02")],
        kind,
    )
    held = spark.createDataFrame([(1, "2001-01-01"), (3, "2001-01-02")], kind)
    due = incremental.not_loaded(source, held, "order_date", "order_id")
    want = {(2, None), (None, "2001-01-02"), (None, None)}
    assert {tuple(r) for r in due.collect()} == want
    again = incremental.not_loaded(source, held.union(due), "order_date", "order_id")
    assert again.count() == 0


def _boom(spark, rows):
    """Rows of which one fails while they are written."""
    return rows.withColumn(
        "id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    )


@pytest.mark.parametrize("partition_by", [(), ("p",)])
def test_a_failed_replacement_leaves_the_old_rows(spark, layers, partition_by):
    table = f"{layers.raw}.t"
    rows = spark.range(10).withColumn("p", F.when(F.col("id") < 9, F.col("id") % 2))
    tables.replace_table(rows, table, partition_by)
    before = sorted(map(tuple, spark.table(table).collect()), key=repr)
    with pytest.raises(PySparkException):
        tables.replace_table(_boom(spark, rows), table, partition_by)
    assert sorted(map(tuple, spark.table(table).collect()), key=repr) == before
    assert [t.name for t in spark.catalog.listTables(layers.raw)] == ["t"]
    tables.replace_table(spark.table(table).filter("id > 5"), table, partition_by)
    assert spark.table(table).count() == 4
    assert spark.table(table).filter("p = 1").count() == 1


def test_a_replacement_that_died_between_names_is_put_back(spark, layers, monkeypatch):
    table = f"{layers.raw}.t"
    tables.replace_table(spark.range(3), table)
    renamed, rename = [], tables._rename

    def dies(*names):
        if renamed:
            raise KeyboardInterrupt  # no Exception: nothing is tidied up
        renamed.append(names)
        rename(*names)

    monkeypatch.setattr(tables, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_table(spark.range(5), table)
    monkeypatch.undo()
    assert not spark.catalog.tableExists(table)
    tables.recover_table(spark, table)
    assert spark.table(table).count() == 3
    tables.replace_table(spark.range(5), table)
    assert spark.table(table).count() == 5
    assert [t.name for t in spark.catalog.listTables(layers.raw)] == ["t"]
    # One version's files are left.
    home = spark.catalog.getDatabase(layers.raw).locationUri.removeprefix("file:")
    assert len([d for d in os.listdir(home) if d.startswith("t__version_")]) == 1


def _day(spark, *rows):
    return spark.createDataFrame(rows, "id long, day string")


def test_batches_are_loaded_once(spark, layers, monkeypatch):
    table = f"{layers.raw}.t"
    first = _day(spark, (1, "2001-01-01"), (2, "2001-01-02"), (3, None))
    assert ledger.append_batch(first, table, "a", "day") == 3
    assert ledger.append_batch(first, table, "a", "day") == 3
    assert ledger.rows(spark, table).count() == 3
    assert ledger.newest(spark, table) == "2001-01-02"
    incoming = first.union(_day(spark, (4, "2001-01-02"), (5, "2001-01-05"), (6, None)))
    due = ledger.due(incoming, table, "day", "id")
    assert sorted(r.id for r in due.collect()) == [4, 5, 6]
    # Dies while rows are written: nothing counts.
    with pytest.raises(PySparkException):
        ledger.append_batch(_boom(spark, _day(spark, (7, "2001-02-01"))), table, "b", "day")
    assert ledger.newest(spark, table) == "2001-01-02"
    # Dies between rows and line: the rows don't count, and the next load drops them.
    monkeypatch.setattr(ledger.F, "current_timestamp", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ledger.append_batch(due, table, "c", "day")
    monkeypatch.undo()
    assert spark.table(table).count() == 6
    assert ledger.rows(spark, table).count() == 3
    due = ledger.due(incoming, table, "day", "id")
    assert ledger.append_batch(due, table, "d", "day") == 3
    assert sorted(r.id for r in spark.table(table).collect()) == [1, 2, 3, 4, 5, 6]
    lines = ledger.batches(spark, table).drop("loaded_at").collect()
    assert sorted(map(tuple, lines)) == [("a", 3, "2001-01-02"), ("d", 3, "2001-01-05")]
    assert ledger.due(incoming, table, "day", "id").isEmpty()


def test_not_loaded_with_any_column_names(spark):
    names = "_key long, _date string, key long"
    incoming = spark.createDataFrame([(1, "2001-01-02", 5), (2, "2001-01-02", 6)], names)
    target = spark.createDataFrame([(1, "2001-01-02", 5)], names)
    due = incremental.not_loaded(incoming, target, "_date", "_key")
    assert [tuple(r) for r in due.collect()] == [(2, "2001-01-02", 6)]


def test_only_touched_months_are_rewritten(spark, layers, shop):
    pipeline.load_raw(spark, shop, layers)
    pipeline.build_staging(spark, layers, as_of="2001-12-31")
    monthly.refresh(spark, layers.staging, layers.marts)

    def files():
        found = spark.table(f"{layers.marts}.{monthly.LINES}")
        paths = found.select("order_year", "order_month", "_metadata.file_path").distinct()
        return {(r[0], r[1]): r[2] for r in paths.collect()}

    before = files()
    new = f.orders(
        spark,
        f.order(4, amount=70.0, day="2001-06-11"),
        f.order(5, amount=30.0, day=None),
        f.order(6, amount=5.0, day="2001-09-01", customer_id=9),
    )
    tables.load_table(new, f"{layers.raw}.orders", "append")
    months = monthly.months_of(staging.stg_orders(new))
    assert sorted(months, key=repr) == [(2001, 6), (2001, 9), (None, None)]
    monthly.refresh(spark, layers.staging, layers.marts, months)
    after = files()
    same = {month for month in before if before[month] == after[month]}
    assert same == set(before) - {(2001, 6)} and set(after) > set(before)
    pipeline.build_marts(spark, layers)
    whole = spark.table(f"{layers.marts}.mart_sales")
    kept = monthly.mart_sales(spark, layers.marts).select(*whole.columns)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, whole.collect()))
    # Again: nothing changes.
    monthly.refresh(spark, layers.staging, layers.marts, months)
    assert sorted(map(repr, monthly.mart_sales(spark, layers.marts).select(*whole.columns).collect())) == sorted(
        map(repr, whole.collect())
    )
