from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom.functions.casts import digits_to_float, retype, text_to_date, text_to_int

WHOLE = [
    ("3.0", 3),
    ("15.7", 15),
    ("-15.7", -15),
    (" 7 ", 7),
    ("+5", 5),
    ("5.", 5),
    (".5", 0),
    ("-.5", 0),
    ("\t8\n", 8),
    ("1e3", None),
    ("3.0.0", None),
    ("12abc", None),
    ("27_", None),
    ("-500", -500),
    ("2147483647", 2147483647),
    ("2147483648", None),
    ("", None),
    ("-", None),
    (None, None),
]


def test_text_to_int(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WHOLE)], "i int, t string")
    got = df.select("i", text_to_int(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [n for _, n in WHOLE]


def test_text_to_int_equals_cast_without_ansi(spark):
    df = spark.createDataFrame([(t,) for t, _ in WHOLE], "t string")
    ours = df.select("t", text_to_int(F.col("t")).alias("n")).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = df.select("t", F.col("t").cast("int").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == plain


def test_retype_of_dirty_text(spark):
    raw = spark.createDataFrame(
        [("1", "2023-1-5", "1.5", "a"), ("x", "2023-01-05 10:00:00", "12_", "b"), ("2.9", "2023-01", None, "c"), (None, "x", "1e2", None)],
        "n string, d string, f string, s string",
    )
    got = retype(raw, {"n": "int", "D": "date", "f": "float"}).collect()
    assert [r.n for r in got] == [1, None, 2, None]
    assert [r.d for r in got] == [dt.date(2023, 1, 5), dt.date(2023, 1, 5), dt.date(2023, 1, 1), None]
    assert [r.f for r in got] == [1.5, None, None, 100.0]
    assert [r.s for r in got] == ["a", "b", "c", None]


def test_retype_keeps_order_and_rejects_absent_columns(spark):
    raw = spark.createDataFrame([("1", "2")], "b string, a string")
    assert retype(raw, {"a": "int"}).dtypes == [("b", "string"), ("a", "int")]
    with pytest.raises(ValueError, match="missing"):
        retype(raw, {"c": "int"})


def test_retype_of_typed_columns(spark):
    raw = spark.createDataFrame([(3.9, 2**40)], "d double, b bigint")
    row = retype(raw, {"d": "int", "b": "int"}).first()
    assert (row.d, row.b) == (3, None)


def test_income_text(spark):
    df = spark.createDataFrame([("34847.84_",), ("_",), ("1.2.3",), ("-5",), (None,)], "t string")
    got = [r[0] for r in df.select(digits_to_float(F.col("t"))).collect()]
    assert got[0] == pytest.approx(34847.84, rel=1e-6)
    assert got[1:] == [None, None, 5.0, None]


def test_dates_with_and_without_a_format(spark):
    df = spark.createDataFrame([("2023-02-01", "01/02/2023"), ("x", "31/02/2000"), (None, None)], "iso string, local string")
    rows = df.select(text_to_date(F.col("iso")), text_to_date(F.col("local"), "dd/MM/yyyy")).collect()
    assert [tuple(map(str, r)) for r in rows] == [("2023-02-01", "2023-02-01"), ("None", "None"), ("None", "None")]
