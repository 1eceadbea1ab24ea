"""Odd inputs that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG_TEXT = "Ab, cd é\n" * 30_000


def documents(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(
        [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOCS
    )


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls, empty, blank and very long texts, repeated rows and ids."""
    return documents(
        spark,
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, " \t\n", "en", "a"),
            (4, LONG_TEXT, "de", "b"),
            (5, "one two three four five six", "en", "a"),
            (5, "one two three four five six", "en", "a"),
            (6, "one two three four five six", "en", "a"),
            (7, "!!! 123 $$$", "en", "a"),
            (7, "another text of the same id here", "fr", "c"),
            (None, "one two three four five six", "en", "a"),
            (None, "日本語 テキスト", None, "c"),
            (8, "word", "en", None),
        ],
    )


def clashing(df: DataFrame) -> DataFrame:
    """With columns that have the names operators use inside."""
    names = (
        "words row place element group items sketch component_id kept probability weight "
        "score secrets spans label tokens topic rep links value own other window "
        "_gone _twice _hit_id _hit_hash hit_id hit_hash hash _mix_tokens _mix_kept "
        "_mix_probability _row _id _doc first key share is_text phase copies code"
    )
    return df.selectExpr("*", *(f"'x' as `{name}`" for name in names.split()))


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
