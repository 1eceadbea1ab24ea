"""A corpus from raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept;
its result is written as a table before the next one begins. All but the last return the
columns of ``documents``; the last adds the ``probability`` a document was drawn with.

* quality: documents that the classifier rejects go;
* near_duplicates: one document of each group stays (the smallest id);
* decontaminate: documents with a window of a benchmark item go;
* secrets: found secrets are masked in the text, and ``n_chars`` follows;
* mix: documents are drawn so that sources, languages and topics meet their shares.

Nulls, empty tables and repeated rows are treated as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import (
    decontamination,
    minhash_dedup,
    mixing,
    quality_mil,
    secret_scan,
)
from sparkmart.llm.tables import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    return quality_mil.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.first_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mix", mix),
]

#: A trained classifier is beyond SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
