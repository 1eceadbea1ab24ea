from __future__ import annotations

import pandas as pd
import pytest

from sparkmart.functions.text import file_headers, normalised_headers
from sparkmart.operators import cleaning, profiling


def test_steps_keep_order(spark):
    df = spark.createDataFrame(
        [(None, None), ("  ", " "), (" a ", "b\t"), ("a", "b"), ("a", None), ("a", None)],
        "`First Name` string, `Sign-Up` string",
    )
    got = cleaning.clean(df)
    assert got.columns == ["first_name", "sign_up"]
    # The row of blanks survives as empty text; NULL equals NULL in duplicates.
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("", ""), ("a", "b"), ("a", None)], key=str
    )
    assert cleaning.clean_report(df).first().asDict() == {
        "rows_in": 6,
        "empty_removed": 1,
        "duplicates_removed": 2,
        "rows_out": 3,
        "columns_out": 2,
    }


def test_report_of_nothing(spark):
    df = spark.createDataFrame([], "a string")
    assert tuple(cleaning.clean_report(df).first()) == (0, 0, 0, 0, 1)


def test_headers():
    assert normalised_headers([" amt", "Sign-Up", "First Name"]) == [
        "amt",
        "sign_up",
        "first_name",
    ]
    with pytest.raises(ValueError, match="First Name.*first-name"):
        normalised_headers(["First Name", "first-name"])
    assert file_headers(["a", "", "a", None]) == ["a", "Unnamed: 1", "a.1", "Unnamed: 3"]


def test_strip_matches_python(spark):
    texts = [f"{chr(c)}x y{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.t for r in cleaning.strip_text(df).collect()]
    assert got == [t.strip() for t in texts]


def test_strip_leaves_other_types(spark):
    df = spark.createDataFrame([(1, 2.5, " a ")], "i int, d double, s string")
    assert tuple(cleaning.strip_text(df).first()) == (1, 2.5, "a")


def test_infer_types(spark):
    df = spark.createDataFrame(
        [
            ("1", "1.5", "True", "x", None, "007", "99999999999999999999"),
            (" 2", None, "false", "1", None, "-3", "1"),
        ],
        "i string, d string, b string, s string, n string, z string, w string",
    )
    got = cleaning.infer_types(df)
    assert dict(got.dtypes) == {
        "i": "bigint",
        "d": "double",
        "b": "boolean",
        "s": "string",
        "n": "double",
        "z": "bigint",
        "w": "double",
    }
    assert tuple(got.first()) == (1, 1.5, True, "x", None, 7, 1e20)


def test_profile(spark):
    frame = pd.DataFrame({"a": [1.0, None, 3.0, 4.0], "b": ["x", None, None, "y"]})
    df = spark.createDataFrame(
        [(1.0, "x"), (None, None), (3.0, None), (4.0, "y")], "a double, b string"
    )
    summary = profiling.summarize(df)
    assert tuple(summary["shape"].first()) == frame.shape
    assert [tuple(r) for r in summary["columns"].collect()] == [
        (0, "a", "double", int(frame.a.isnull().sum())),
        (1, "b", "string", int(frame.b.isnull().sum())),
    ]
    assert summary["preview"].count() == 3
    assert [r.a for r in profiling.preview(df, "a", rows=2).collect()] == [None, 1.0]
