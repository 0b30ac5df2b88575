"""Whole-history features from states by month, so that a rebuilt month costs a month and not the history.

A state is what a stretch of months has left of a customer's or a loan's rows. States of one key merge, in any grouping and in any order, to the
state of all their months, and features are read off a merged state. Months are stored one by one, as the silver tables are; months that
won't change any more may be merged into one state for good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.features import NOT_FEATURES, loan_aggregates, loan_columns
from creditloom.sources.schemas import CUSTOMER, SNAPSHOT

SINCE, UNTIL = "since", "until"  # first and last date of a state


def profile_states(df: DataFrame, columns: Sequence[str], key: str = CUSTOMER, order: str = SNAPSHOT, ties: Sequence[str] = ()) -> DataFrame:
    """A state for each key and date: of every column count, sum, squared deviations, extremes, first and last value.

    `ties` orders rows of the same date. Sums that overflow are NULL, and so is then the mean.
    """
    by = F.struct(order, *ties)

    def state(c: str) -> Column:
        parts = {
            "n": F.count(c),
            "total": F.try_sum(c),
            "spread": F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)),
            "low": F.min(c),
            "high": F.max(c),
            "first": F.min_by(c, by),
            "last": F.max_by(c, by),
        }
        return F.struct(*[value.alias(name) for name, value in parts.items()]).alias(c)

    dated = df.groupBy(key, order).agg(F.min(order).alias(SINCE), F.max(order).alias(UNTIL), *[state(c) for c in columns])
    return dated.select(key, SINCE, UNTIL, *columns, order)


def merge_profiles(states: DataFrame, columns: Sequence[str], key: str = CUSTOMER) -> DataFrame:
    """One state for each key. A key has as many states as months at most, so they meet in one array.

    The squared deviations are those within the states and those of their means from the mean of all, so nothing cancels.
    """
    by_date = F.array_sort(F.collect_list(F.struct(SINCE, UNTIL, *columns))).alias("states")
    met = states.groupBy(key).agg(by_date)

    def merged(c: str) -> Column:
        each = F.col(f"states.{c}")
        known = F.filter(each, lambda x: x["n"] > 0)
        n = F.aggregate(known, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        kind = states.schema[c].dataType["total"].dataType
        total = F.aggregate(known, F.lit(0).cast(kind), lambda a, x: F.try_add(a, x["total"]))
        mean = F.try_divide(total.cast("double"), n)
        apart = lambda x: F.pow(x["total"] / x["n"] - mean, F.lit(2.0)) * x["n"]
        spread = F.aggregate(known, F.lit(0.0), lambda a, x: a + x["spread"] + apart(x))
        parts = {
            "n": n,
            "total": F.when(n > 0, total),
            "spread": spread,
            "low": F.array_min(F.transform(known, lambda x: x["low"])),
            "high": F.array_max(F.transform(known, lambda x: x["high"])),
            "first": F.element_at(each, 1)["first"],
            "last": F.element_at(each, -1)["last"],
        }
        return F.struct(*[value.alias(name) for name, value in parts.items()]).alias(c)

    return met.select(key, F.array_min("states.since").alias(SINCE), F.array_max("states.until").alias(UNTIL), *[merged(c) for c in columns])


def profiles(merged: DataFrame, columns: Sequence[str], key: str = CUSTOMER) -> DataFrame:
    """The columns of `activity_profile` from one state for each key."""

    def statistics(c: str) -> list[Column]:
        n, variance = F.col(f"{c}.n"), F.col(f"{c}.spread") / (F.col(f"{c}.n") - 1)
        found = {
            "mean": F.try_divide(F.col(f"{c}.total").cast("double"), n),
            "std": F.when(n > 1, F.sqrt(variance)),
            "min": F.col(f"{c}.low"),
            "max": F.col(f"{c}.high"),
        }
        return [value.alias(f"{c}_{name}") for name, value in found.items()]

    deltas = [F.try_subtract(f"{c}.last", f"{c}.first").alias(f"{c}_delta") for c in columns]
    return merged.select(key, *[s for c in columns for s in statistics(c)], *deltas)


def loan_states(df: DataFrame, key: str = "loan_id", order: str = SNAPSHOT, owner: str = CUSTOMER) -> DataFrame:
    """A state for each loan and date: the latest row, sums, and the earliest start."""
    columns = df.columns
    dated = df.withColumn("__month", F.col(order))
    return dated.groupBy(key, "__month").agg(*loan_aggregates(columns, key, order, owner)).withColumnRenamed("__month", order)


def merge_loans(states: DataFrame, key: str = "loan_id") -> DataFrame:
    """One state for each loan; partial maxima and sums travel, one for each loan and task."""
    return states.groupBy(key).agg(
        F.max("__newest").alias("__newest"),
        F.sum("total_paid_amt").alias("total_paid_amt"),
        F.sum("num_months_overdue").alias("num_months_overdue"),
        F.max("latest_snapshot_date").alias("latest_snapshot_date"),
        F.min("__started").alias("__started"),
    )


def loan_history(merged: DataFrame, key: str = "loan_id", exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """The columns of `loan_features` from one state for each loan."""
    return loan_columns(merged, key, exclude)
