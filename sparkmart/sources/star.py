"""Raw tables derived from the star-schema Parquet tables used for testing.

The rules (and the dirt they plant: NULL keys, blanks, odd case, zero amounts)
are listed in ``FIXTURES.md``. ``dirty=False`` leaves the planted dirt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(whole: Column) -> Column:
    """A whole number of cents as exact money."""
    scaled = whole.cast("decimal(12,2)") * F.lit("0.01").cast("decimal(3,2)")
    return scaled.cast("decimal(10,2)")


def raw_customers(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    if dirty:
        full_name = (
            F.when(key % 307 == 5, F.lit(None))
            .when(key % 13 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
            .otherwise(name)
        )
        email = F.when(
            key % 211 != 1, F.concat(F.lit(" "), name, F.lit("@Example.COM"))
        )
    else:
        full_name, email = name, F.concat(name, F.lit("@example.com"))
    signup = F.date_add(F.lit("2000-01-01").cast("date"), (key * 37 % 730).cast("int"))
    if dirty:
        signup = F.when(key % 311 != 7, signup)
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            full_name.alias("name"),
            email.alias("email"),
            F.concat(F.lit("City "), (key % 40).cast("string")).alias("city"),
            F.col("n_name").alias("state"),
            signup.cast("string").alias("created_at"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    key, kind = F.col("p_partkey"), F.col("p_type")
    stock = (F.col("p_size") - 1).cast("bigint")
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("name"),
        (F.when(key % 97 != 3, kind) if dirty else kind).alias("category"),
        _cents(key * 37 % 50000).alias("price"),
        (F.when(key % 89 != 5, stock) if dirty else stock).alias("stock"),
    )


def raw_orders(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    amount = _cents(F.floor("o_totalprice") % 50000)
    residue = key % 4
    day = F.col("o_orderdate").cast("date").cast("string")
    if dirty:
        day = F.when(key % 1019 != 3, day)
        buyer = F.when(key % 1013 != 2, buyer)
        amount = F.when(key % 1009 == 0, F.lit(None)).otherwise(
            F.when(key % 997 == 0, F.lit(0).cast("decimal(10,2)")).otherwise(amount)
        )
        status = (
            F.when(key % 991 == 7, F.lit(None))
            .when(key % 40 == 0, "COMPLETED")
            .when(key % 40 == 4, " completed ")
            .when(residue == 0, "completed")
        )
    else:
        status = F.when(residue == 0, "completed")
    status = (
        status.when(residue == 1, "pending")
        .when(residue == 2, "cancelled")
        .otherwise("refunded")
    )
    first_line = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_partkey").alias("product_id"),
            F.max("l_quantity").alias("quantity"),
        )
    )
    return (
        table(spark, sf_dir, "orders")
        .join(first_line, key == F.col("l_orderkey"), "left")
        .select(
            key.alias("order_id"),
            buyer.alias("customer_id"),
            F.col("product_id"),
            F.col("quantity").cast("bigint").alias("quantity"),
            amount.alias("amount"),
            status.alias("status"),
            day.alias("order_date"),
        )
    )


def messy(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with blanks around a text, repeated rows and rows of NULLs planted."""
    blanks = F.when(F.col(key) % 41 == 0, F.lit(" \t")).when(
        F.col(key) % 43 == 0, F.concat(F.lit("\n "), F.col(text), F.lit("  "))
    )
    padded = df.withColumn(text, F.coalesce(blanks, F.col(text)))
    nothing = df.filter(F.col(key) % 53 == 2).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema)
    )
    return padded.union(padded.filter(F.col(key) % 47 == 1)).union(nothing)


def faulty(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Models with repeated keys, NULLs and values outside their lists planted."""

    def plant(df: DataFrame, key: str, column: str, every: int, value) -> DataFrame:
        changed = F.when(F.col(key) % every == 3, F.lit(value).cast(df.schema[column].dataType))
        kept = F.when(F.coalesce(F.col(key) % every != 3, F.lit(True)), F.col(column))
        return df.withColumn(column, F.coalesce(changed, kept))

    out = dict(models)
    for name, key, faults in (
        ("stg_orders", "order_id", (("status", 301, "unknown"), ("amount", 401, None))),
        (
            "stg_customers",
            "customer_id",
            (("customer_segment", 61, "Former"), ("email", 71, None)),
        ),
        (
            "stg_products",
            "product_id",
            (("price_tier", 31, "Luxury"), ("stock_status", 37, "Lost")),
        ),
        ("mart_sales", "order_id", (("amount", 503, None),)),
        ("mart_customers", "customer_id", (("customer_value_tier", 67, "Unknown"),)),
    ):
        df = out[name]
        for column, every, value in faults:
            df = plant(df, key, column, every, value)
        out[name] = df.union(df.filter(F.col(key) % 89 == 4))
    return out


def untyped(orders: DataFrame) -> DataFrame:
    """Orders as texts, some of which no cast takes; by ``order_id``.

    % 71 = 2 has a letter before its id, % 73 = 2 a decimal comma in its amount, % 79 = 2 a
    13th month, % 83 = 2 a quantity in words and an id as for % 71, % 89 = 2 blanks around its
    amount, which casts take.
    """
    key = F.col("order_id")
    texts = {f.name: F.col(f.name).cast("string") for f in orders.schema}
    amount, day = texts["amount"], F.col("order_date")
    texts["order_id"] = F.when(
        (key % 71 == 2) | (key % 83 == 2), F.concat(F.lit("x"), key)
    ).otherwise(texts["order_id"])
    texts["amount"] = (
        F.when(key % 73 == 2, F.replace(amount, F.lit("."), F.lit(",")))
        .when(key % 89 == 2, F.concat(F.lit(" "), amount, F.lit(" ")))
        .otherwise(amount)
    )
    texts["order_date"] = F.when(
        key % 79 == 2, F.concat(F.substring(day, 1, 5), F.lit("13"), F.substring(day, 8, 3))
    ).otherwise(day)
    texts["quantity"] = F.when(key % 83 == 2, "many").otherwise(texts["quantity"])
    return orders.select(*(text.alias(name) for name, text in texts.items()))


def rest_pages(
    records: DataFrame, key: str, folder: str, size: int = 1000
) -> list[str]:
    """``records`` as the pages of a REST endpoint; returns the pages' addresses.

    A page is a file that holds one JSON array, of the records whose whole-number ``key`` lies
    in its range of ``size``; NULL fields are left out of a record. One more page is empty.
    """
    pages = (
        records.select(
            F.floor(F.col(key) / size).alias("page"),
            F.struct(key, F.struct(*records.columns).alias("record")).alias("entry"),
        )
        .groupBy("page")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select("page", F.to_json("entries.record").alias("value"))
    )
    # A file for each row, in one folder: a folder for each page takes most of the time.
    pages.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/full")
    spark = records.sparkSession
    spark.createDataFrame([("[]",)], "value string").write.text(f"{folder}/empty")
    written = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="part-*")
        .load(folder)
        .filter("length > 0")
        .select("path")
    )
    return sorted(row.path for row in written.collect())


def malformed_csv(orders: DataFrame, folder: str, size: int = 5000) -> None:
    """Orders as CSV files of ``size`` keys each, with lines that break the rules planted.

    By ``order_id``: % 11 = 1 has two fields too many and % 13 = 1 ends in a separator (both
    too long), % 17 = 1 stops behind its third field, % 19 = 1 spells missing values, % 23 = 1
    has quotes, separators and spaces in its status, and % 29 = 1 a line break, but only in every
    other file. Files begin with the header; blank lines follow each % 31 = 1.
    """
    key = F.col("order_id")
    file = F.floor(key / size).alias("file")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    status = (
        F.when(key % 19 == 1, "N/A")
        .when(key % 23 == 1, F.concat(F.lit('" ""'), shown("status"), F.lit('"", so ,"')))
        .when(
            (key % 29 == 1) & (F.floor(key / size) % 2 == 1),
            F.concat(F.lit('"'), shown("status"), F.lit('\nand ""more"""')),
        )
        .otherwise(shown("status"))
    )
    amount = F.when(key % 19 == 1, "null").otherwise(shown("amount"))
    head = F.concat_ws(",", *(shown(n) for n in orders.columns[:3]))
    tail = F.concat_ws(",", shown("quantity"), amount, status, shown("order_date"))
    line = (
        F.when(key % 17 == 1, head)
        .when(key % 11 == 1, F.concat_ws(",", head, tail, F.lit("too,many")))
        .when(key % 13 == 1, F.concat_ws(",", head, tail, F.lit("")))
        .otherwise(F.concat_ws(",", head, tail))
    )
    line = F.when(key % 31 == 1, F.concat(line, F.lit("\n"))).otherwise(line)
    lines = orders.select(file, key.alias("at"), line.alias("value"))
    headers = (
        lines.select("file").distinct().select(
            "file", F.lit(-1).alias("at"), F.lit(",".join(orders.columns)).alias("value")
        )
    )
    (
        headers.union(lines)
        .repartition("file")
        .sortWithinPartitions("file", "at")
        .select("file", "value")
        .write.partitionBy("file")
        .text(folder)
    )
