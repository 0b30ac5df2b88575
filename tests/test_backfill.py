"""CSV sources to gold, against values worked out by hand."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest

from creditloom.__main__ import main
from creditloom.plans.backfill import Mart, backfill, bronze_table, build_gold, silver_tables
from helpers import bag

LOANS = """loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date
L1,C1,2023-01-01,10,5,1000,100,100,0,500,2023-06-01
L1,C1,2023-01-01,10,6,1000,100,0,100,500,2023-07-01
L2,C2,2023-01-01,10,6,1000,100,100,0,400,2023-07-01
L3,C9,2023-02-01,10,6,1000,100,0,250,900,2023-08-01
L4,C1,2023-02-01,10,6,1000,100,0,250,900,2023-08-15
"""
CLICKS = "fe_1," + ",".join(f"fe_{i}" for i in range(2, 21)) + ",Customer_ID,snapshot_date\n" + "".join(
    f"{first}," + ",".join(["1"] * 19) + f",{customer},{day}\n"
    for first, customer, day in [
        (10, "C1", "2023-06-01"),
        (20, "C1", "2023-07-01"),
        ("x", "C2", "2023-07-01"),
        (40, "", "2023-07-01"),
        (50, "C9", "2023-09-01"),
    ]
)
ATTRIBUTES = """Customer_ID,Name,Age,SSN,Occupation,snapshot_date
C1, Ann ,30,123-45-6789,Doctor,2023-01-01
C2,Ann,12_,bad,_______,2023-01-01
"""
FINANCIALS = """Customer_ID,Annual_Income,Monthly_Inhand_Salary,Num_Bank_Accounts,Num_Credit_Card,Interest_Rate,Num_of_Loan,Type_of_Loan,Delay_from_due_date,Num_of_Delayed_Payment,Changed_Credit_Limit,Num_Credit_Inquiries,Credit_Mix,Outstanding_Debt,Credit_Utilization_Ratio,Credit_History_Age,Payment_of_Min_Amount,Total_EMI_per_month,Amount_invested_monthly,Payment_Behaviour,Monthly_Balance,snapshot_date
C1,19114.12_,1824.5,3,4,3,2.0,"Auto Loan, and Payday Loan",3,7_,11.25,4,_,809.5,26.5,22 Years and 1 Months,No,49.5,80.5,High_spent,312.25,2023-01-01
C2,500,,3_,4,3,0,Payday Loan,3,7,1.5,4,Good,809.5,26.5,NA,Yes,49.5,__10000__,!@9#%8,1,2023-01-01
"""


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    for name, text in {
        "lms_loan_daily": LOANS,
        "feature_clickstream": CLICKS,
        "features_attributes": ATTRIBUTES,
        "features_financials": FINANCIALS,
    }.items():
        (folder / f"{name}.csv").write_text(text)
    return folder


@pytest.fixture
def mart(source, tmp_path):
    return Mart(str(source), str(tmp_path / "mart"), "2023-06-01", "2023-08-01")


def gold(spark, mart, table):
    return spark.read.parquet(mart.path("gold", table))


def test_whole_mart(spark, mart):
    audits = backfill(spark, mart)
    assert {name: audit.rejected for name, audit in audits.items() if audit.rejected} == {"bronze/lms_loan_daily": 1}
    rows = {name: audit.rows for name, audit in audits.items()}
    assert rows == {
        "bronze/features_attributes": 2,
        "bronze/features_financials": 2,
        "bronze/feature_clickstream": 4,
        "bronze/lms_loan_daily": 4,
        "silver/features_attributes": 2,
        "silver/features_financials": 2,
        "silver/feature_clickstream": 3,
        "silver/lms_loan_daily": 4,
        "gold/label_store": 3,
        "gold/feature_store": 3,
    }
    labels = {r.loan_id: (r.customer_id, r.label, r.label_def, r.snapshot_date) for r in gold(spark, mart, "label_store").collect()}
    july, august = dt.date(2023, 7, 1), dt.date(2023, 8, 1)
    assert labels == {
        "L1": ("C1", 1, "30dpd_6mob", july),
        "L2": ("C2", 0, "30dpd_6mob", july),
        "L3": ("C9", 1, "30dpd_6mob", august),
    }
    features = {r.loan_id: r for r in gold(spark, mart, "feature_store").collect()}
    one, two, three = features["L1"], features["L2"], features["L3"]
    assert (one.has_overdue_amt, one.has_missed_payment, one.installments_missed, one.fe_1) == (1, 1, 1, 20)
    assert (one.age, one.age_valid, one.ssn_valid, one.occupation, one.name_shared_count) == (30, 1, 1, "Doctor", 2)
    assert (one.auto_loan, one.payday_loan, one.credit_history_total_months, one.num_of_loan) == (1, 1, 265, 2)
    assert (one.credit_mix_good, one.valid_credit_mix, one.pb_high_spent, one.pb_0) == (0, 0, 1, 0)
    assert one.annual_income == pytest.approx(19114.12, rel=1e-6) and one.num_of_delayed_payment is None
    assert (two.fe_1, two.fe_2, two.age, two.occupation_known, two.is_name_shared) == (None, 1, None, 0, 1)
    assert (two.num_bank_accounts, two.payment_of_min_amount, two.credit_history_total_months) == (None, 1, None)
    assert (two.pb_0, two.has_valid_payment_behavior, two.credit_mix_good, two.amount_invested_monthly) == (1, 1, 1, None)
    assert (three.fe_1, three.age, three.annual_income, three.installments_missed) == (None, None, None, 3)


def test_command_line(spark, mart, monkeypatch, capsys):
    options = {"source": mart.source, "root": mart.root, "start": "2023-06-01", "end": "2023-08-01", "dpd": "60"}
    monkeypatch.setattr("sys.argv", ["creditloom", *[part for k, v in options.items() for part in (f"--{k}", v)]])
    main()
    assert "gold/label_store: 3 rows, 2 snapshots" in capsys.readouterr().out
    assert gold(spark, mart, "label_store").first().label_def == "60dpd_6mob"


def test_given_vocabularies_fix_the_columns(spark, mart):
    fixed = replace(mart, loan_items=["Auto Loan", "Mortgage Loan"], behaviours=["low_spent"], junk_as=None)
    backfill(spark, fixed)
    row = gold(spark, mart, "feature_store").where("loan_id = 'L1'").first().asDict()
    assert (row["auto_loan"], row["mortgage_loan"], row["pb_low_spent"]) == (1, 0, 0)
    assert not {"payday_loan", "pb_high_spent", "pb_0"} & set(row)


def test_silver_types(spark, mart):
    backfill(spark, mart)
    silver = silver_tables(spark, mart)
    loans = dict(silver["lms_loan_daily"].dtypes)
    assert (loans["due_amt"], loans["mob"], loans["dpd"], loans["snapshot_date"]) == ("float", "int", "int", "date")
    clicks = dict(silver["feature_clickstream"].dtypes)
    assert {clicks[f"fe_{i}"] for i in range(1, 21)} == {"int"}


def test_bronze_keeps_text_and_month_starts(spark, mart):
    backfill(spark, mart)
    bronze = bronze_table(spark, mart, "lms_loan_daily")
    assert {t for c, t in bronze.dtypes if c != "snapshot_date"} == {"string"}
    assert sorted(r.loan_id for r in bronze.collect()) == ["L1", "L1", "L2", "L3"]


def test_rerun_of_one_month_follows_its_source(spark, mart, source):
    backfill(spark, mart)
    (source / "lms_loan_daily.csv").write_text(LOANS.replace("0,100,500,2023-07-01", "100,0,500,2023-07-01"))
    again = Mart(mart.source, mart.root, "2023-07-01", "2023-07-01")
    audits = backfill(spark, again)
    assert audits["gold/label_store"].rows == 2
    labels = {r.loan_id: r.label for r in gold(spark, mart, "label_store").collect()}
    assert labels == {"L1": 0, "L2": 0, "L3": 1}


def test_rerun_empties_a_month_that_lost_its_rows(spark, mart, source):
    backfill(spark, mart)
    (source / "lms_loan_daily.csv").write_text("\n".join(LOANS.splitlines()[:-2]) + "\n")
    backfill(spark, mart)
    assert {r.loan_id for r in gold(spark, mart, "label_store").collect()} == {"L1", "L2"}


def test_month_by_month_equals_the_whole_range(spark, mart, tmp_path):
    backfill(spark, mart)
    single = replace(mart, root=str(tmp_path / "single"), exclude=["installments_missed"])
    for month in ("2023-06-01", "2023-07-01", "2023-08-01"):
        backfill(spark, replace(single, start=month, end=month))
    assert bag(gold(spark, mart, "label_store")) == bag(gold(spark, single, "label_store"))
    features = gold(spark, single, "feature_store")
    assert bag(gold(spark, mart, "feature_store").drop("installments_missed")) == bag(features)


def test_months_without_any_rows_are_valid(spark, mart):
    early = replace(mart, start="2022-01-01", end="2022-03-01")
    audits = backfill(spark, early)
    assert {a.rows for name, a in audits.items() if "features_" not in name} == {0}
    assert gold(spark, mart, "label_store").count() == gold(spark, mart, "feature_store").count() == 0
    backfill(spark, mart)
    assert gold(spark, mart, "feature_store").count() == 3


def test_other_label_definition(spark, mart):
    backfill(spark, mart)
    strict = Mart(mart.source, mart.root, mart.start, mart.end, dpd=60)
    build_gold(spark, strict)
    labels = {r.loan_id: (r.label, r.label_def) for r in gold(spark, mart, "label_store").collect()}
    assert labels == {"L1": (0, "60dpd_6mob"), "L2": (0, "60dpd_6mob"), "L3": (1, "60dpd_6mob")}


def test_vocabularies_have_a_limit(spark, mart):
    with pytest.raises(ValueError, match="more than 1 distinct"):
        backfill(spark, replace(mart, max_vocabulary=1))


def test_bronze_keeps_blanks(spark, mart, source):
    (source / "features_financials.csv").write_text(FINANCIALS.replace(",Yes,", ", Yes,"))
    backfill(spark, mart)
    assert gold(spark, mart, "feature_store").where("loan_id = 'L2'").first().payment_of_min_amount == 0


def test_repeated_customers_can_be_refused(spark, mart, source):
    (source / "features_attributes.csv").write_text(ATTRIBUTES + ATTRIBUTES.splitlines()[1] + "\n")
    backfill(spark, mart)
    assert gold(spark, mart, "feature_store").count() == 4
    careful = Mart(mart.source, mart.root, mart.start, mart.end, unique_customers=True)
    with pytest.raises(ValueError, match="not unique"):
        build_gold(spark, careful)
