from __future__ import annotations

import datetime as dt

import pytest

from creditloom.operators.delinquency import days_past_due, installments_missed
from creditloom.operators.labels import bad_rate_curve, default_label, dpd_flag, label_definition, outcomes_at
from creditloom.plans.gold import label_store
from creditloom.plans.silver import silver_loans

COLUMNS = (
    "loan_id string, customer_id string, loan_start_date string, tenure string, installment_num string,"
    " loan_amt string, due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string"
)


def loans(spark, *rows):
    """Rows of (snapshot, installment, due, overdue)."""
    data = [
        (f"L{i}", f"C{i}", "2023-01-01", "10", num, "1000", due, "0", overdue, "900", snapshot)
        for i, (snapshot, num, due, overdue) in enumerate(rows)
    ]
    return spark.createDataFrame(data, COLUMNS)


def by_loan(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("loan_id").collect()]


def test_installments_missed_rounds_up_and_fills(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (50.0, 0.0), (250.0, 100.0), (100.0, 100.0), (None, 100.0), (50.0, None)],
        "overdue_amt double, due_amt double",
    )
    got = installments_missed(df).collect()
    assert [r.installments_missed for r in got] == [0, 0, 3, 1, 0, 0]
    assert got[4].overdue_amt == 0.0 and got[5].due_amt == 0.0


def test_fill_can_be_limited(spark):
    df = spark.createDataFrame([(None, 1.0, None)], "overdue_amt double, due_amt double, other int")
    assert installments_missed(df).first().other == 0
    limited = installments_missed(df, fill=["overdue_amt"]).first()
    assert (limited.other, limited.overdue_amt, limited.installments_missed) == (None, 0.0, 0)


def test_float_amounts_overshoot_a_whole_ratio_and_decimals_do_not(spark):
    raw = loans(spark, ("2023-06-01", "6", "0.1", "0.3"))
    assert silver_loans(raw).first().installments_missed == 4
    assert silver_loans(raw, money="decimal(12,2)").first().installments_missed == 3
    double = spark.createDataFrame([(0.3, 0.1)], "overdue_amt double, due_amt double")
    assert installments_missed(double).first().installments_missed == 3


def test_days_past_due_follow_the_calendar(spark):
    raw = loans(
        spark,
        ("2023-03-31", "3", "100", "50"),
        ("2023-03-01", "3", "100", "50"),
        ("2023-02-01", "2", "100", "50"),
        ("2023-03-31", "3", "100", "300"),
        ("2023-03-01", "3", "100", "0"),
    )
    got = by_loan(silver_loans(raw), "installments_missed", "first_missed_date", "dpd")
    assert got == [
        (1, dt.date(2023, 2, 28), 31),
        (1, dt.date(2023, 2, 1), 28),
        (1, dt.date(2023, 1, 1), 31),
        (3, dt.date(2022, 12, 31), 90),
        (0, None, 0),
    ]


def test_overdue_with_nothing_due_has_unknown_days_and_a_good_label(spark):
    silver = silver_loans(loans(spark, ("2023-07-01", "6", "0", "50")))
    assert silver.first().dpd is None
    assert label_store(silver).first().label == 0


def test_one_missed_installment_flips_the_label_in_february_only(spark):
    raw = loans(spark, ("2023-03-01", "6", "100", "100"), ("2023-06-01", "6", "100", "100"))
    assert [r[1] for r in by_loan(label_store(silver_loans(raw)), "loan_id", "label")] == [0, 1]


def test_label_store_columns_and_month(spark):
    raw = loans(spark, ("2023-06-01", "6", "100", "300"), ("2023-06-01", "5", "100", "300"), ("2023-06-01", "6.0", "100", "0"))
    store = label_store(silver_loans(raw))
    assert store.columns == ["loan_id", "customer_id", "label", "label_def", "snapshot_date"]
    assert by_loan(store, "loan_id", "label", "label_def") == [("L0", 1, "30dpd_6mob"), ("L2", 0, "30dpd_6mob")]
    assert label_definition(60, 3) == "60dpd_3mob"
    assert default_label(silver_loans(raw), dpd=100, mob=6).where("label = 1").count() == 0


def test_bad_numbers_become_zero(spark):
    silver = silver_loans(loans(spark, ("2023-06-01", "x", "n/a", None)))
    row = silver.first()
    assert (row.mob, row.due_amt, row.overdue_amt, row.dpd, row.installments_missed) == (0, 0.0, 0.0, 0, 0)


def test_bad_rate_curve_and_outcomes(spark):
    df = spark.createDataFrame(
        [
            (1, 0, 1, dt.date(2023, 1, 1)),
            (1, 40, 1, dt.date(2023, 1, 1)),
            (2, 30, 10, dt.date(2023, 12, 31)),
            (2, None, 2, dt.date(2023, 1, 1)),
            (2, 90, 10, dt.date(2024, 1, 1)),
            (None, 90, 3, dt.date(2023, 1, 1)),
        ],
        "mob int, dpd int, installment_num int, loan_start_date date",
    )
    flagged = dpd_flag(df, 30, started_before="2024-01-01")
    assert [tuple(r) for r in bad_rate_curve(flagged).collect()] == [(1, 0.5), (2, pytest.approx(0.5))]
    assert outcomes_at(flagged, 10).count() == 1
    assert dpd_flag(df).count() == 6


def test_days_past_due_on_its_own_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31), 1, 5.0)], "snap date, missed int, owed double")
    row = days_past_due(df, "snap", "owed", "missed", "since", "days").first()
    assert (row.since, row.days) == (dt.date(2024, 2, 29), 31)


MOST = (1 << 31) - 1


def test_thousands_of_years_past_due(spark):
    raw = loans(spark, ("2023-06-01", "6", "0.25", "3750"), ("2023-06-01", "6", "0.25", "3000"), ("2023-06-01", "6", "0.25", "5000"))
    silver = silver_loans(raw)
    assert by_loan(silver, "installments_missed", "first_missed_date")[:2] == [(15_000, dt.date(773, 6, 1)), (12_000, dt.date(1023, 6, 1))]
    assert by_loan(silver, "dpd")[0] == ((dt.date(2023, 6, 1) - dt.date(773, 6, 1)).days,)
    assert by_loan(label_store(silver), "label") == [(1,), (1,), (1,)]


@pytest.mark.parametrize("missed", [70_500_000, 70_555_965, 70_555_967, 70_555_968, 70_600_000, MOST])
def test_dates_out_of_the_calendar_stay_overdue(spark, missed):
    """The last count whose first missed month the date type holds is 70,555,967 before June 2023."""
    df = spark.sql(f"SELECT date'2023-06-15' snapshot_date, 1.0D overdue_amt, {missed} installments_missed")
    row = days_past_due(df).selectExpr("dpd", "unix_date(first_missed_date) since", "month(first_missed_date) month").first()
    assert row.since < -2_145_000_000 and row.dpd == min(MOST, 19_523 - row.since)
    assert row.month == (7 if missed >= 70_555_967 else (5 - missed) % 12 + 1)


@pytest.mark.parametrize("due, overdue", [("0.0000152587890625", "70000"), ("0.25", "Infinity"), ("1", "2147483648")])
def test_more_installments_than_integers(spark, due, overdue):
    silver = silver_loans(loans(spark, ("2023-06-01", "6", due, overdue))).select("installments_missed", "dpd")
    assert tuple(silver.first()) == (MOST, MOST)
    decimal = spark.createDataFrame([(1,)], "x int").selectExpr("9999999999.99D overdue_amt", "cast(0.01 as decimal(12,2)) due_amt")
    assert installments_missed(decimal.selectExpr("cast(overdue_amt as decimal(12,2)) overdue_amt", "due_amt")).first().installments_missed == MOST


def test_far_dates_survive_parquet(spark, tmp_path):
    silver = silver_loans(loans(spark, ("2023-06-01", "6", "0.25", "3750"), ("2023-06-01", "6", "0.0009765625", "71000")))
    silver.write.parquet(str(tmp_path / "far"))
    stored = spark.read.parquet(str(tmp_path / "far")).selectExpr("loan_id", "unix_date(first_missed_date) since", "dpd")
    assert by_loan(stored, "since", "dpd") == by_loan(silver.selectExpr("loan_id", "unix_date(first_missed_date) since", "dpd"), "since", "dpd")
