"""CSV reading, compared with what pandas makes of the same bytes."""

from __future__ import annotations

import io

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkmart.functions.text import MISSING_TOKENS
from sparkmart.schemas import RAW_ORDERS
from sparkmart.sinks.files import write_csv
from sparkmart.sources.delimited import load_and_clean, read_csv

MESSY = (
    "a,b,c\n"
    "1,2,3\n"
    "1,2\n"
    "1,2,3,4\n"
    "1,2,3,\n"
    "1,2,3,,\n"
    ",,\n"
    "\n"
    '"x, y","say ""hi""",z\n'
    '"long, one","and ""two""",3,4\n'
    '"short, one"\n'
    "NA,null,3\n"
    " , ,\n"
    "1,2,3\n"
    "é,ü,ß\n"
)


def pandas_rows(text):
    frame = pd.read_csv(io.StringIO(text), on_bad_lines="skip", dtype=str)
    return sorted(
        (tuple(None if pd.isna(v) else v for v in row) for row in frame.values), key=repr
    )


def spark_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def put(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.mark.parametrize("multi_line", [True, False, None])
def test_messy_lines(spark, tmp_path, multi_line):
    df = read_csv(spark, put(tmp_path, MESSY), multi_line=multi_line)
    assert spark_rows(df) == pandas_rows(MESSY)
    assert len(pandas_rows(MESSY)) == 9


def test_line_breaks_in_fields(spark, tmp_path):
    text = 'id,body\n1,"two\nlines"\n2,"a ""b""\n\nc"\n3,"x\ny",too,many\n4\n5,"p\nq"\n'
    df = read_csv(spark, put(tmp_path, text))
    assert spark_rows(df) == pandas_rows(text)


def test_windows_line_ends(spark, tmp_path):
    text = MESSY.replace("\n", "\r\n")
    for multi_line in (True, False):
        df = read_csv(spark, put(tmp_path, text), multi_line=multi_line)
        assert spark_rows(df) == pandas_rows(text)


def test_pruned_columns_and_count_see_the_same_rows(spark, tmp_path):
    df = read_csv(spark, put(tmp_path, MESSY))
    rows = pandas_rows(MESSY)
    assert df.count() == len(rows)
    assert spark_rows(df.select("b")) == sorted(((r[1],) for r in rows), key=repr)
    assert df.filter("a = '1'").count() == sum(r[0] == "1" for r in rows)


def test_missing_tokens(spark, tmp_path):
    text = "k,v\n" + "".join(f"{i},{t}\n" for i, t in enumerate(MISSING_TOKENS))
    text += '98,""\n99,kept\n'
    df = read_csv(spark, put(tmp_path, text))
    assert spark_rows(df) == pandas_rows(text)


def test_many_files_share_a_header(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"a,b\n{i},x\n{i},y,z\n", f"part{i}.csv")
    assert spark_rows(read_csv(spark, str(tmp_path))) == [(str(i), "x") for i in range(3)]


def test_load_and_clean(spark, tmp_path):
    text = " First Name,Sign-Up,amt\n ann ,2001-01-01,1\nann,2001-01-01,1\n,,\nbob,,2.5\n"
    df = load_and_clean(spark, put(tmp_path, text))
    assert dict(df.dtypes) == {"first_name": "string", "sign_up": "string", "amt": "double"}
    assert spark_rows(df) == sorted([("ann", "2001-01-01", 1.0), ("bob", None, 2.5)], key=repr)


def test_declared_schema(spark, tmp_path):
    text = (
        "Order-ID,customer id,product_id,quantity,amount,status,order_date\n"
        "1,2,3,4,5,completed,2001-01-01\n2,,,,,NA,\n"
    )
    df = load_and_clean(spark, put(tmp_path, text), RAW_ORDERS)
    assert [f.dataType for f in df.schema] == [f.dataType for f in RAW_ORDERS]
    assert df.columns == RAW_ORDERS.names
    assert spark_rows(df)[0] == (1, 2, 3, 4, 5.0, "completed", "2001-01-01")
    with pytest.raises(PySparkException):
        load_and_clean(
            spark, put(tmp_path, text.replace("5,c", "five,c")), RAW_ORDERS
        ).collect()


def test_duplicates_are_found_among_values(spark, tmp_path):
    text = "k,v\n1,1\n1,1.0\n 1,1\n2,x\n"
    df = load_and_clean(spark, put(tmp_path, text.replace("x", "3")))
    assert spark_rows(df) == [(1, 1.0), (2, 3.0)]
    frame = pd.read_csv(io.StringIO(text.replace("x", "3")))
    assert sorted(map(tuple, frame.drop_duplicates().values)) == spark_rows(df)


def test_colliding_headers_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="First Name"):
        load_and_clean(spark, put(tmp_path, "First Name,first-name\n1,2\n"))


def test_absent_and_empty_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError):
        read_csv(spark, put(tmp_path, ""))


def test_no_python_in_the_scan(spark, tmp_path):
    plan = read_csv(spark, put(tmp_path, MESSY))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_write_then_read(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, " a,\"b\"\nc ", {"x": 1}), (2, None, None)], "k int, t string, m map<string,int>"
    )
    folder = str(tmp_path / "out")
    write_csv(df, folder)
    back = read_csv(spark, folder)
    assert spark_rows(back) == [("1", ' a,"b"\nc ', '{"x":1}'), ("2", None, None)]
    frame = pd.concat(
        pd.read_csv(p, dtype=str) for p in (tmp_path / "out").glob("part*.csv")
    )
    assert sorted(frame.t.dropna()) == [' a,"b"\nc ']
    assert back.filter(F.col("t").isNull()).count() == 1


@pytest.mark.parametrize("column", [["1D", "2F"], ["0x1p3"], ["12d", "13"], ["1e3", "inf"], ["1.", ".5"], ["1_000"], ["+1", " 2"]])
def test_types_are_those_of_pandas(spark, tmp_path, column):
    text = "a,b\n" + "".join(f"{value},x\n" for value in column)
    want = pd.read_csv(io.StringIO(text))["a"]
    got = load_and_clean(spark, put(tmp_path, text))
    kind = dict(got.dtypes)["a"]
    assert kind == {"int64": "bigint", "float64": "double"}.get(str(want.dtype), "string")
    assert {r.a for r in got.collect()} == set(want.tolist())


def test_header_with_a_line_break(spark, tmp_path):
    text = 'a,"two\nlines"\n1,2\n'
    assert list(read_csv(spark, put(tmp_path, text)).columns) == ["a", "two\nlines"]
    assert spark_rows(read_csv(spark, put(tmp_path, text))) == [("1", "2")]


def test_differing_headers_raise(spark, tmp_path):
    put(tmp_path, "id,name\n1,x\n", "one.csv")
    put(tmp_path, "name,id\ny,2\n", "two.csv")
    with pytest.raises(ValueError, match="differing headers"):
        read_csv(spark, str(tmp_path))


def test_only_the_file_with_an_open_quote_is_unsplit(spark, tmp_path):
    put(tmp_path, 'a,b\n1,"x\ny"\n', "one.csv")
    put(tmp_path, "a,b\n2,z\n3,w\n", "two b.csv")
    df = read_csv(spark, str(tmp_path))
    assert spark_rows(df) == [("1", "x\ny"), ("2", "z"), ("3", "w")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_other_bytes_raise_and_name_the_file(spark, tmp_path):
    put(tmp_path, "a,b\n1,ü\n", "good.csv")
    for k, line in enumerate((b"2,\xff\n", b"2,\xe9t\xe9\n", b"2,\xc3\n", b"2,\xed\xa0\x80\n")):
        (tmp_path / "latin one.csv").write_bytes(b"a,b\n1,x\n" + line)
        with pytest.raises(ValueError, match="latin one.csv is not UTF-8: 1 line"):
            read_csv(spark, str(tmp_path))
        with pytest.raises(UnicodeDecodeError):
            pd.read_csv(tmp_path / "latin one.csv", dtype=str)


def test_only_files_with_open_quotes_are_read_whole(spark, tmp_path):
    """Each file is read once: split, or whole if a field goes on behind a line."""
    text = "a,b\n" + "".join(f"{i},x\n" for i in range(50))
    for name in ("one.csv", "two & 50%.csv", "drei ü.csv"):
        put(tmp_path, text, name)
    put(tmp_path, 'a,b\n1,"p\nq"\n2,r,s\n', "open é.csv")
    df = read_csv(spark, str(tmp_path))
    wanted = pandas_rows(text) * 3 + [("1", "p\nq")]
    assert spark_rows(df) == sorted(wanted, key=repr)
    plan = df._jdf.queryExecution()
    plan.toRdd().count()
    leaves = plan.executedPlan().collectLeaves()
    read = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
    assert sorted(read) == [1, 3]


def test_one_header_spelled_in_two_ways(spark, tmp_path):
    put(tmp_path, "a,b\n1,2\n", "plain.csv")
    put(tmp_path, '"a","b"\n3,4\n', "quoted.csv")
    assert spark_rows(read_csv(spark, str(tmp_path))) == [("1", "2"), ("3", "4")]
