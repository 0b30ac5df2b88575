from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom.functions.dates import is_month_start, month_starts, months_spanned, snapshot_label, vintage


def d(text):
    return dt.date.fromisoformat(text)


def test_month_starts_of_two_years(spark):
    days = [r[0] for r in month_starts(spark, "2023-01-01", "2024-12-01").collect()]
    assert len(days) == 24 and days[0] == d("2023-01-01") and days[-1] == d("2024-12-01")


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2023-01-15", "2023-03-01", ["2023-01-01", "2023-02-01", "2023-03-01"]),
        ("2023-01-31", "2023-02-28", ["2023-01-01", "2023-02-01"]),
        ("2023-11-30", "2024-01-31", ["2023-11-01", "2023-12-01", "2024-01-01"]),
        ("2023-05-02", "2023-05-01", ["2023-05-01"]),
        ("2023-05-02", "2023-04-30", []),
    ],
)
def test_month_starts_begin_with_the_first_month(spark, start, end, expected):
    assert [str(r[0]) for r in month_starts(spark, start, end).collect()] == expected


def test_months_spanned(spark):
    df = spark.createDataFrame([(d("2023-03-09"),), (d("2023-01-31"),), (None,)], "day date")
    assert [str(r[0]) for r in months_spanned(df, "day").collect()] == ["2023-01-01", "2023-02-01", "2023-03-01"]
    assert months_spanned(df.where("false"), "day").count() == 0


def test_label_and_month_start(spark):
    df = spark.createDataFrame([(d("2023-03-01"),), (d("2023-03-02"),)], "day date")
    rows = df.select(snapshot_label(F.col("day")), is_month_start(F.col("day"))).collect()
    assert [tuple(r) for r in rows] == [("2023_03_01", True), ("2023_03_02", False)]


def test_months_between_and_vintage_bounds(spark):
    pairs = [
        ("2023-04-01", "2023-01-01", "mid"),
        ("2023-03-31", "2023-02-28", "new"),
        ("2023-03-15", "2023-01-01", "new"),
        ("2023-06-30", "2023-01-01", "mid"),
        ("2023-07-01", "2023-01-01", "old"),
        ("2023-07-01", None, "old"),
    ]
    df = spark.createDataFrame([(d(a), d(b) if b else None) for a, b, _ in pairs], "latest date, started date")
    got = [r[0] for r in df.select(vintage(F.col("latest"), F.col("started"))).collect()]
    assert got == [v for *_, v in pairs]
