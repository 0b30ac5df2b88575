from __future__ import annotations

import pytest

from creditloom.operators.encoding import (
    credit_mix_flags,
    item_column,
    learn_items,
    learn_levels,
    multi_hot,
    one_hot,
)
from creditloom.plans.silver import silver_financials


def lists(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def test_items_after_and_are_not_learned(spark):
    df = lists(spark, "Auto Loan, and Home Equity Loan", "Not Specified, Auto Loan, and Auto Loan", None)
    assert learn_items(df, "t") == ["Auto Loan", "Not Specified"]
    assert learn_items(df, "t", strip_conjunction=True) == ["Auto Loan", "Home Equity Loan", "Not Specified"]


def test_words_that_only_begin_with_and_are_items(spark):
    assert learn_items(lists(spark, "Android Loan,AND x,  b "), "t") == ["Android Loan", "b"]


def test_multi_hot_by_substring_and_by_item(spark):
    df = lists(spark, "Home Loan", "Home", None, "X, and Home")
    found = multi_hot(df, "t", ["Home", "Home Loan"]).orderBy("i").collect()
    assert [(r.home, r.home_loan) for r in found] == [(1, 1), (1, 0), (0, 0), (1, 0)]
    exact = multi_hot(df, "t", ["Home", "Home Loan"], exact=True).orderBy("i").collect()
    assert [(r.home, r.home_loan) for r in exact] == [(0, 1), (1, 0), (0, 0), (1, 0)]


def test_multi_hot_sums_equal_rows_with_the_item(spark):
    df = lists(spark, "Auto Loan, Payday Loan", "Auto Loan", "Payday Loan, and Auto Loan", None)
    row = multi_hot(df, "t", learn_items(df, "t")).groupBy().sum("auto_loan", "payday_loan").first()
    assert tuple(row) == (df.where("t like '%Auto Loan%'").count(), df.where("t like '%Payday Loan%'").count())


def test_colliding_names_are_rejected(spark):
    assert item_column("Credit-Builder Loan") == "credit_builder_loan"
    with pytest.raises(ValueError, match="clash"):
        multi_hot(lists(spark, "a"), "t", ["A B", "a-b"])
    with pytest.raises(ValueError, match="clash"):
        multi_hot(lists(spark, "a"), "t", ["T"])


def test_vocabulary_limit(spark):
    df = lists(spark, "a", "b", "c")
    assert learn_levels(df, "t", limit=3) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="more than 2"):
        learn_levels(df, "t", limit=2)


def test_one_hot_null_convention(spark):
    df = lists(spark, "x", None)
    assert [r.p_x for r in one_hot(df, "t", ["x"], "p_").orderBy("i").collect()] == [1, None]
    assert [r.p_x for r in one_hot(df, "t", ["x"], "p_", null_as=0).orderBy("i").collect()] == [1, 0]


def test_credit_mix_flags(spark):
    df = spark.createDataFrame([("Good",), ("Bad",), ("Standard",), ("good",), (None,)], "credit_mix string")
    rows = [tuple(r)[1:] for r in credit_mix_flags(df).collect()]
    assert rows == [(1, 0, 0, 1), (0, 1, 0, 1), (0, 0, 1, 1), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_vocabularies_can_be_given(spark):
    raw = spark.createDataFrame(
        [("1", "5", "Yes", None, "Auto Loan", "Good", "!@9#%8")],
        "customer_id string, annual_income string, payment_of_min_amount string, credit_history_age string,"
        " type_of_loan string, credit_mix string, payment_behaviour string",
    )
    learned = silver_financials(raw)
    given = silver_financials(raw, items=["Auto Loan", "Payday Loan"], behaviours=["0", "low"])
    assert "pb_0" in learned.columns and "payday_loan" not in learned.columns
    assert (given.first().payday_loan, given.first().auto_loan, given.first().pb_low) == (0, 1, 0)
    assert not {"type_of_loan", "credit_history_age"} & set(learned.columns)
