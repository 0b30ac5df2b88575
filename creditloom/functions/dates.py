"""Month calendar, snapshot labels and loan age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Loan age in months below which a loan is new, then mid; anything else is old.
NEW_BELOW_MONTHS = 3
MID_BELOW_MONTHS = 6


def month_starts(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """First days of all months from the month of `start` up to `end`, as `snapshot_date`."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return expand_months(bounds, "start", "end")


def months_spanned(df: DataFrame, date: str) -> DataFrame:
    """First days of all months between the earliest and the latest `date` in `df`."""
    return expand_months(df.agg(F.min(date).alias("start"), F.max(date).alias("end")), "start", "end")


def expand_months(bounds: DataFrame, start: str, end: str) -> DataFrame:
    first, last = F.trunc(F.col(start), "MM"), F.col(end).cast("date")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("snapshot_date"))


def is_month_start(date: Column) -> Column:
    return F.trunc(date, "MM") == date


def snapshot_label(date: Column) -> Column:
    """Date as the `yyyy_MM_dd` suffix used in file names."""
    return F.date_format(date, "yyyy_MM_dd")


def vintage(latest: Column, started: Column) -> Column:
    """'new', 'mid' or 'old' by the months between loan start and latest snapshot; unknown age is 'old'."""
    age = F.months_between(latest, started)
    return F.when(age < NEW_BELOW_MONTHS, "new").when(age < MID_BELOW_MONTHS, "mid").otherwise("old")
