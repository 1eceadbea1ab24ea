"""Labelled training rows: all of them, or a bounded sample that is the same in every run."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.tables import bounded


def held_out(doc_id: str | Column, parts: int, part: int) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, by remainder."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    rest = F.crc32(column.cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, per_label: int
) -> DataFrame:
    """(text, label) of at most ``per_label`` documents with label 0 and with label 1.

    Held-out, null and other labels are left out. Which rows are taken depends on a
    hash of their ids alone. The sample is bounded, so it is what is broadcast. Of a repeated
    id, one row is taken for each label that it has: that with the least text.
    """
    usable = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & ~held_out("_id", parts, part))
        .distinct()
    )
    taken = [
        usable.where(F.col("label") == value)
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(per_label)
        for value in (0, 1)
    ]
    return (
        docs.select(F.col("doc_id").alias("_doc"), "text")
        .join(F.broadcast(taken[0].union(taken[1])), F.col("_doc") == F.col("_id"))
        .groupBy("_id", "label")
        .agg(F.min("text").alias("text"))
        .select("text", "label")
    )


def rows(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int
) -> DataFrame:
    """(place, label, lang, text) of all documents with label 0 or 1 that may be learned from.

    Held-out, null and other labels are left out. Of a repeated id, one row is taken for each
    label that it has: that with the least text. ``place`` is a hash of id and label.
    """
    usable = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & ~held_out("_id", parts, part))
        .where(F.col("label").isin(0, 1))
        .distinct()
    )
    row = F.struct(F.col("text").isNull().alias("none"), "text", "lang")
    return (
        docs.select(F.col("doc_id").alias("_doc"), "text", "lang")
        .join(bounded(usable), F.col("_doc") == F.col("_id"))
        .groupBy("_id", "label")
        .agg(F.min(row).alias("row"))
        .select(F.xxhash64("_id", "label").alias("place"), "label", "row.lang", "row.text")
    )


def shares(labels: DataFrame, label: str, parts: int, part: int) -> tuple[int, int]:
    """How many rows that may be learned from have label 0 and label 1."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, part))
    row = usable.agg(
        F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))
    ).first()
    return int(row[0]), int(row[1])


def train_in_task(sample: DataFrame, train: Callable[[pa.Table], object]) -> object:
    """What ``train`` makes of the whole bounded sample, in one task.

    It must be made of plain values and arrays. The sample's rows come in any order.
    """
    schema = sample.limit(0).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = train(pa.Table.from_batches(list(batches), schema))
        yield pa.record_batch([pa.array([pickle.dumps(made)], pa.binary())], names=["made"])

    return pickle.loads(sample.repartition(1).mapInArrow(run, "made binary").first()[0])
