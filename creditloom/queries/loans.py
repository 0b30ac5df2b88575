"""Delinquency, labels and whole-history loan features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.features import latest_per_key, loan_features, loan_totals, loan_vintage, vintage_flags
from creditloom.operators.history import loan_history, loan_states, merge_loans
from creditloom.operators.labels import bad_rate_curve, default_label, dpd_flag, outcomes_at
from creditloom.plans.gold import label_store
from creditloom.plans.silver import silver_loans
from creditloom.queries.inputs import loan_panel, raw_loans
from creditloom.queries.oracle import DIRTY, FAR, LOAN_FEATURES, LOANS, TOTALS, VINTAGE
from creditloom.queries.shape import widened
from creditloom.session import scratch_folder
from creditloom.sources.readers import read_snapshots
from creditloom.sources.writers import write_snapshots

CUTOFF = "2000-01-01"
FINAL_INSTALLMENT = 7
ANALYSED_DPD = 30


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_loans(loan_panel(spark, sf_dir))


def q01_label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_store(panel(spark, sf_dir))


def q02_dpd_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver loan table from dirty text."""
    return widened(silver_loans(raw_loans(spark, sf_dir)))


def q03_bad_rate_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_rate_curve(dpd_flag(panel(spark, sf_dir), ANALYSED_DPD, started_before=CUTOFF))


def q04_actual_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = dpd_flag(panel(spark, sf_dir), ANALYSED_DPD, started_before=CUTOFF)
    outcome = outcomes_at(flagged, FINAL_INSTALLMENT)
    return outcome.select("loan_id", "customer_id", "loan_start_date", "snapshot_date", "dpd", "dpd_flag")


def q05_dpd_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the length of the months before the snapshot moves days past due across the label threshold."""
    flagged = dpd_flag(panel(spark, sf_dir), ANALYSED_DPD)
    return flagged.groupBy("installments_missed", F.month("snapshot_date").alias("snapshot_month"), "dpd").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("dpd_flag").alias("n_flagged")
    )


def q56_far_overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans thousands of years past due, with a first missed date before all calendars, or with more installments than integers."""
    kind = F.col("loan_id").cast("bigint") % 3
    due = F.when(kind == 0, 0.25).when(kind == 1, 0.0009765625).otherwise(0.0000152587890625)
    overdue = F.when(kind == 0, 3750.5).when(kind == 1, 71_000.0).otherwise(70_000.0)
    far = silver_loans(loan_panel(spark, sf_dir).withColumns({"due_amt": due, "overdue_amt": overdue}))
    labels = default_label(far).select("loan_id", "snapshot_date", "label")
    year = F.when(kind == 0, F.year("first_missed_date")).alias("first_missed_year")
    rows = far.select("loan_id", "snapshot_date", "installments_missed", "dpd", year)
    return rows.join(labels, ["loan_id", "snapshot_date"], "left")


def q25_loan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_totals(panel(spark, sf_dir))


def q26_latest_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(latest_per_key(panel(spark, sf_dir), ties=["installment_num"]))


def q27_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintage_flags(loan_vintage(panel(spark, sf_dir)))


def q28_loan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(loan_features(panel(spark, sf_dir)))


def q61_loans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan features merged from months, of which two years were wrong at first and have been built again."""
    folder = scratch_folder(spark, "q61", sf_dir)
    rows = panel(spark, sf_dir)
    again = F.col("snapshot_date").between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-01").cast("date"))
    wrong = rows.withColumn("paid_amt", F.when(again, 1.0).otherwise(F.col("paid_amt")))
    # States lie by loan and month in tasks of a fair size, so they are written from there instead of being shuffled once more.
    write_snapshots(loan_states(wrong), folder, rebalance=False)
    write_snapshots(loan_states(rows.where(again)), folder, "1996-01-01", "1997-12-01", rebalance=False)
    return widened(loan_history(merge_loans(read_snapshots(spark, folder))))


QUERIES = {
    f.__name__: f
    for f in (
        q01_label_store,
        q02_dpd_panel,
        q03_bad_rate_curve,
        q04_actual_outcomes,
        q05_dpd_month_end,
        q25_loan_totals,
        q26_latest_loan,
        q27_vintage,
        q28_loan_features,
        q56_far_overdue,
        q61_loans_by_month,
    )
}

ORACLE = {
    "q01_label_store": f"""WITH {LOANS}
SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
FROM loans WHERE mob = 6""",
    "q02_dpd_panel": f"WITH {DIRTY}\nSELECT * FROM loans",
    "q03_bad_rate_curve": f"""WITH {LOANS}
SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate
FROM loans WHERE loan_start_date < DATE '2000-01-01' AND mob IS NOT NULL GROUP BY mob ORDER BY mob""",
    "q04_actual_outcomes": f"""WITH {LOANS}
SELECT loan_id, customer_id, loan_start_date, snapshot_date, dpd, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
FROM loans WHERE loan_start_date < DATE '2000-01-01' AND installment_num = 7""",
    "q05_dpd_month_end": f"""WITH {LOANS}
SELECT installments_missed, CAST(month(snapshot_date) AS INT) AS snapshot_month, dpd, count(*) AS n_rows,
  CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged
FROM loans GROUP BY 1, 2, 3""",
    "q56_far_overdue": f"""WITH {FAR},
counted AS (SELECT *, CAST(least(ceil(overdue_amt / due_amt), 2147483647) AS BIGINT) AS missed FROM far),
dated AS (SELECT *, CASE WHEN missed < 20000 THEN CAST(snapshot_date - to_months(CAST(missed AS INT)) AS DATE) END AS since FROM counted)
SELECT loan_id, snapshot_date, CAST(missed AS INT) AS installments_missed,
  CAST(CASE WHEN since IS NOT NULL THEN date_diff('day', since, snapshot_date) ELSE 2147483647 END AS INT) AS dpd,
  CAST(year(since) AS INT) AS first_missed_year, CASE WHEN installment_num = 6 THEN 1 END AS label FROM dated""",
    "q25_loan_totals": f"""WITH {LOANS}, {TOTALS}
SELECT loan_id, total_paid_amt, num_months_overdue, latest_snapshot_date FROM totals""",
    "q26_latest_loan": f"WITH {LOANS}, {TOTALS}\nSELECT * FROM latest",
    "q27_vintage": f"""WITH {LOANS}, {TOTALS}, aged AS (SELECT *, {VINTAGE} AS vintage FROM totals)
SELECT loan_id, started AS loan_start_date, latest_snapshot_date, vintage AS loan_vintage,
  CAST(month(started) AS INT) AS loan_start_month, CAST(year(started) AS INT) AS loan_start_year,
  CASE WHEN vintage = 'old' THEN 1 ELSE 0 END AS loan_vintage_old,
  CASE WHEN vintage = 'mid' THEN 1 ELSE 0 END AS loan_vintage_mid,
  CASE WHEN vintage = 'new' THEN 1 ELSE 0 END AS loan_vintage_new
FROM aged""",
    "q28_loan_features": f"WITH {LOANS}, {LOAN_FEATURES}\nSELECT * FROM loan_features",
}
ORACLE["q61_loans_by_month"] = ORACLE["q28_loan_features"]
