"""States by month merge to the features of all rows, in any grouping."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators.features import activity_profile, loan_features
from creditloom.operators.history import SINCE, loan_history, loan_states, merge_loans, merge_profiles, profile_states, profiles
from creditloom.queries.shape import rounded
from creditloom.sources.readers import read_snapshots
from creditloom.sources.writers import write_snapshots
from helpers import bag

COLUMNS = ["fe_1", "fe_2"]
MONTHS = [dt.date(2023, m, 1) for m in range(1, 7)]


def clicks(spark, seed=1, count=400):
    rnd = random.Random(seed)
    value = lambda: rnd.choice([None, 0, rnd.randrange(-50, 50), 1_000_000_000 + rnd.randrange(3)])
    rows = [(rnd.choice(["a", "b", "c", "d", None]), rnd.choice(MONTHS), k, value(), None if rnd.random() < 0.7 else value()) for k in range(count)]
    rows.append(("alone", MONTHS[2], 1, None, 5))
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date, tie int, fe_1 int, fe_2 int")


def expected(df):
    return bag(rounded(activity_profile(df, COLUMNS, ties=["tie"])))


@pytest.mark.parametrize("cuts", [[], [MONTHS[3]], [MONTHS[1], MONTHS[4]]])
def test_profiles_from_months_in_any_grouping(spark, cuts):
    df = clicks(spark)
    states = profile_states(df, COLUMNS, ties=["tie"])
    group = sum((F.col("snapshot_date") >= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    parts = states.withColumn("part", group)
    merged = [merge_profiles(parts.where(F.col("part") == k), COLUMNS) for k in range(len(cuts) + 1)]
    whole = merged[0]
    for part in merged[1:]:
        whole = merge_profiles(part.unionByName(whole), COLUMNS)
    assert bag(rounded(profiles(whole, COLUMNS))) == expected(df)


def test_a_rebuilt_month_costs_a_month(spark, tmp_path):
    root, df = str(tmp_path / "states"), clicks(spark)
    write_snapshots(profile_states(df.withColumn("fe_1", F.lit(7)), COLUMNS, ties=["tie"]), root)
    for month in MONTHS:
        write_snapshots(profile_states(df.where(F.col("snapshot_date") == F.lit(month)), COLUMNS, ties=["tie"]), root, month, month)
    assert bag(rounded(profiles(merge_profiles(read_snapshots(spark, root), COLUMNS), COLUMNS))) == expected(df)


def test_large_values_that_hardly_differ(spark):
    """Sums of squares would lose these deviations."""
    rows = [("a", MONTHS[k % 3], k, 2_000_000_000 + k % 2, k) for k in range(60)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date, tie int, fe_1 int, fe_2 int")
    row = profiles(merge_profiles(profile_states(df, COLUMNS), COLUMNS), COLUMNS).first()
    assert row.fe_1_std == pytest.approx(0.50421949, rel=1e-6)


def test_no_rows(spark):
    df = clicks(spark).where("1 = 0")
    assert profiles(merge_profiles(profile_states(df, COLUMNS), COLUMNS), COLUMNS).collect() == []


def loans(spark, seed=2):
    rnd = random.Random(seed)
    rows = []
    for k in range(40):
        start = rnd.choice(MONTHS[:3])
        for month in rnd.sample(MONTHS, 4):
            for _ in range(rnd.choice([1, 1, 2])):
                owed = rnd.choice([0.0, 0.0, 25.0, None])
                rows.append((f"L{k}" if k else None, rnd.choice(["a", "b"]), start, rnd.randrange(9), rnd.choice([1.0, 2.5]), owed, start if owed else None, month))
    columns = "loan_id string, customer_id string, loan_start_date date, installment_num int, paid_amt double, overdue_amt double, first_missed_date date, snapshot_date date"
    return spark.createDataFrame(rows, columns)


def test_loans_from_months(spark, tmp_path):
    root, df = str(tmp_path / "states"), loans(spark)
    write_snapshots(loan_states(df.withColumn("paid_amt", F.lit(9.0))), root)
    for month in MONTHS[:4]:
        write_snapshots(loan_states(df.where(F.col("snapshot_date") == F.lit(month))), root, month, month)
    late = F.col("snapshot_date") >= F.lit(MONTHS[4])
    mixed = df.withColumn("paid_amt", F.when(late, 9.0).otherwise(F.col("paid_amt")))
    states = read_snapshots(spark, root)
    early, rest = merge_loans(states.where(~late)), merge_loans(states.where(late))
    assert bag(loan_history(merge_loans(early.unionByName(rest)))) == bag(loan_features(mixed))
    assert SINCE not in loan_history(early).columns
