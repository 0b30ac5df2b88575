from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom.operators.features import (
    activity_profile,
    first_last,
    first_last_delta,
    latest_owner,
    latest_per_key,
    loan_features,
    loan_totals,
    loan_vintage,
    snapshot_dates,
    vintage_flags,
)
from creditloom.plans.gold import customer_matrix, feature_store, label_store
from creditloom.plans.silver import silver_attributes, silver_financials
from creditloom.queries.inputs import attributes, clicks, financials
from creditloom.queries.loans import panel
from helpers import bag

SF = "/root/testdata/sf0.001"


def day(n):
    return dt.date(2023, 1, n)


@pytest.fixture(scope="module")
def activity(spark):
    rows = [("a", day(1), 1, None), ("a", day(2), 9, 4), ("a", day(3), 5, 7), ("b", day(1), None, 2)]
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date, x int, y int").repartition(3).cache()


def test_first_and_last_keep_nulls(activity):
    rows = {r.customer_id: r for r in first_last(activity, ["x", "y"]).collect()}
    assert (rows["a"].x_first, rows["a"].x_last, rows["a"].y_first, rows["a"].y_last) == (1, 5, None, 7)
    assert (rows["b"].x_first, rows["b"].x_last) == (None, None)


def test_delta(activity):
    rows = {r.customer_id: r for r in first_last_delta(activity, ["x", "y"]).collect()}
    assert (rows["a"].x_delta, rows["a"].y_delta, rows["b"].x_delta, rows["b"].y_delta) == (4, None, None, 0)


def test_profile_is_statistics_and_deltas(activity):
    rows = {r.customer_id: r for r in activity_profile(activity, ["x", "y"]).collect()}
    a, b = rows["a"], rows["b"]
    assert (a.x_mean, a.x_std, a.x_min, a.x_max, a.x_delta) == (5.0, pytest.approx(4.0), 1, 9, 4)
    assert (b.y_mean, b.y_std, b.y_min, b.y_max) == (2.0, None, 2, 2)
    assert (b.x_mean, b.x_min) == (None, None)


def test_ties_are_ordered_when_asked(spark):
    df = spark.createDataFrame([("a", day(1), 1), ("a", day(1), 2), ("a", day(1), 3)], "customer_id string, snapshot_date date, x int")
    row = first_last(df.repartition(3), ["x"], ties=["x"]).first()
    assert (row.x_first, row.x_last) == (1, 3)
    assert latest_per_key(df, "customer_id", ties=["x"]).first().x == 3


def test_latest_per_key_has_one_row_per_key(spark):
    loans = panel(spark, SF)
    latest = latest_per_key(loans, ties=["installment_num"])
    assert latest.count() == loans.select("loan_id").distinct().count()


def test_vintage_flags_are_exclusive(spark):
    flags = vintage_flags(loan_vintage(panel(spark, SF)))
    total = F.col("loan_vintage_old") + F.col("loan_vintage_mid") + F.col("loan_vintage_new")
    assert flags.where(total != 1).count() == 0


def test_loan_features_equal_the_joined_parts(spark):
    loans = panel(spark, SF)
    parts = (
        latest_per_key(loans, ties=["installment_num"])
        .join(loan_totals(loans).drop("latest_snapshot_date"), "loan_id")
        .drop("loan_start_date")
        .join(vintage_flags(loan_vintage(loans)).drop("loan_start_date", "latest_snapshot_date", "loan_vintage"), "loan_id")
        .withColumn("has_overdue_amt", F.expr("if(overdue_amt > 0, 1, 0)"))
        .withColumn("has_missed_payment", F.expr("if(first_missed_date is not null, 1, 0)"))
        .drop("due_amt", "paid_amt", "first_missed_date")
    )
    features = loan_features(loans)
    assert sorted(features.columns) == sorted(parts.columns)
    assert bag(features) == bag(parts)
    assert bag(features, ["loan_id", "customer_id"]) == bag(latest_owner(loans))


@pytest.fixture(scope="module")
def silver(spark):
    return (
        panel(spark, SF).cache(),
        silver_attributes(attributes(spark, SF)).cache(),
        silver_financials(financials(spark, SF)).cache(),
        clicks(spark, SF).cache(),
    )


def test_label_and_feature_store_have_the_panel_rows_of_the_month(silver):
    loans, *_ = silver
    at_six = loans.where("mob = 6").count()
    store = feature_store(*silver)
    assert label_store(loans).count() == store.count() == at_six
    assert not {"mob", "dpd", "due_amt", "paid_amt", "first_missed_date", "loan_start_date"} & set(store.columns)
    assert not {"credit_mix", "payment_behaviour", "credit_history_years"} & set(store.columns)


def test_feature_store_equals_the_month_by_month_build(silver):
    loans, attribute, financial, click = silver
    store = feature_store(*silver)
    clicked = store.where(F.coalesce(*[f"fe_{i}" for i in range(1, 21)]).isNotNull())
    months = [r[0] for r in clicked.select("snapshot_date").distinct().orderBy("snapshot_date").take(4)]
    assert months
    for month in months:
        one = feature_store(
            loans.where(F.col("snapshot_date") == month),
            attribute,
            financial,
            click.where(F.col("snapshot_date") == month),
        )
        assert bag(one) == bag(store.where(F.col("snapshot_date") == month))


def test_excluded_columns_and_repeated_customers(silver):
    loans, attribute, financial, click = silver
    store = feature_store(loans, attribute.unionAll(attribute), financial, click, exclude=["installments_missed"])
    assert "installments_missed" not in store.columns
    assert store.count() == 2 * loans.where("mob = 6").count()


def test_matrix_keeps_customers_without_loans(silver):
    loans, attribute, financial, click = silver
    few = loans.where("customer_id < '3'")
    matrix = customer_matrix(few, attribute, financial, click)
    kept = {r[0] for r in matrix.select("customer_id").distinct().collect()}
    assert kept == {r[0] for r in click.select("customer_id").distinct().collect()}
    without = matrix.where("loan_id is null")
    assert without.where("age is not null or annual_income is not null").count() == 0
    assert without.count() == without.select("customer_id").distinct().count() > 0


def test_snapshot_dates_are_sorted_and_distinct(silver):
    days = [r[0] for r in snapshot_dates(silver[0]).collect()]
    assert days == sorted(set(days))
