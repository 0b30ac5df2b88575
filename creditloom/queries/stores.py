"""Click cleaning and profiles, the feature store, and the customer matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.casts import retype
from creditloom.operators.duplicates import keys_with_many
from creditloom.operators.features import (
    activity_profile,
    activity_statistics,
    first_last,
    first_last_delta,
    snapshot_dates,
)
from creditloom.operators.history import merge_profiles, profile_states, profiles
from creditloom.operators.profiling import null_counts
from creditloom.plans.backfill import Mart, bucket_count, stored_features, stored_matrix, write_silver_table
from creditloom.plans.gold import customer_matrix, feature_store
from creditloom.plans.silver import silver_attributes, silver_clicks, silver_financials
from creditloom.queries.inputs import attributes, clicks, financials, raw_clicks
from creditloom.queries.loans import panel
from creditloom.queries.oracle import (
    CLEAN_ATTRIBUTES,
    CLEAN_FINANCIALS,
    CLICKS,
    DIRTY_CLICKS,
    FE,
    FEATURES,
    LOAN_FEATURES,
    LOANS,
    MATRIX,
    PROFILE,
    PROFILE_COLUMNS,
)
from creditloom.queries.shape import rounded, widened
from creditloom.session import scratch_folder
from creditloom.sources.readers import read_snapshots
from creditloom.sources.schemas import CLICK_FEATURES, MONTHLY_TABLES
from creditloom.sources.writers import write_snapshots

REBUILT = "1996-05-01"


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        panel(spark, sf_dir),
        silver_attributes(attributes(spark, sf_dir)),
        silver_financials(financials(spark, sf_dir)),
        clicks(spark, sf_dir),
    )


def q20_click_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_clicks(raw_clicks(spark, sf_dir))


def q21_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = retype(raw_clicks(spark, sf_dir), dict.fromkeys(CLICK_FEATURES, "int"))
    return null_counts(typed, CLICK_FEATURES)


def q22_click_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(activity_statistics(clicks(spark, sf_dir), CLICK_FEATURES))


def q23_click_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers go from one end of the integers to the other, which has no difference in integers."""
    odd_month = F.month("snapshot_date") % 2 == 1
    far = F.when(F.col("customer_id").cast("bigint") % 19 == 0, F.when(odd_month, 2_000_000_000).otherwise(-2_000_000_000))
    wide = clicks(spark, sf_dir).withColumn("fe_1", F.coalesce(far, "fe_1").cast("int"))
    return first_last_delta(wide, CLICK_FEATURES)


def q24_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_last(clicks(spark, sf_dir), CLICK_FEATURES)


def q29_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(feature_store(*_silver(spark, sf_dir)))


def q30_customer_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(widened(customer_matrix(*_silver(spark, sf_dir))))


def _stored_mart(spark: SparkSession, sf_dir: str, name: str) -> Mart:
    """Silver tables of all months in buckets by customer, as many as their rows make, with the counts of their frequent keys."""
    names = ("lms_loan_daily", "features_attributes", "features_financials", "feature_clickstream")
    tables = dict(zip(names, _silver(spark, sf_dir), strict=True))
    undated = F.lit(None).cast("date").alias("snapshot_date")
    days = [df.select("snapshot_date" if t in MONTHLY_TABLES else undated) for t, df in tables.items()]
    counted = reduce(DataFrame.union, days).agg(F.min("snapshot_date"), F.max("snapshot_date"), F.count(F.lit(1)))
    first, last, rows = counted.first()
    mart = Mart("", scratch_folder(spark, name, sf_dir), first, last, buckets=bucket_count(rows))
    for table, df in tables.items():
        write_silver_table(mart, table, df, ["customer_id"])
    return mart


def q58_stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store over bucketed silver tables: no count first, and no shuffle below the joins."""
    return widened(stored_features(spark, _stored_mart(spark, sf_dir, "q58")))


def q59_stored_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer matrix over the same."""
    return rounded(widened(stored_matrix(spark, _stored_mart(spark, sf_dir, "q59"))))


def q60_profiles_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles merged from months, one of which was wrong at first and has been built again; early months merged for good."""
    folder = scratch_folder(spark, "q60", sf_dir)
    rows = clicks(spark, sf_dir)
    wrong = rows.withColumn("fe_3", F.when(F.col("snapshot_date") != F.lit(REBUILT).cast("date"), F.col("fe_3")))
    write_snapshots(profile_states(wrong, CLICK_FEATURES), folder)
    again = rows.where(F.col("snapshot_date") == F.lit(REBUILT).cast("date"))
    write_snapshots(profile_states(again, CLICK_FEATURES), folder, REBUILT, REBUILT)
    states = read_snapshots(spark, folder).withColumn("early", F.col("snapshot_date") < F.lit("1997-01-01").cast("date"))
    early = merge_profiles(states.where("early"), CLICK_FEATURES)
    late = states.where("not early").select(early.columns)
    return rounded(profiles(merge_profiles(early.union(late), CLICK_FEATURES), CLICK_FEATURES))


def q31_multi_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys_with_many(feature_store(*_silver(spark, sf_dir)), "customer_id", "loan_id")


def q32_snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_dates(customer_matrix(*_silver(spark, sf_dir)))


def q48_activity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and deltas from one aggregation."""
    return rounded(activity_profile(clicks(spark, sf_dir), CLICK_FEATURES))


QUERIES = {
    f.__name__: f
    for f in (
        q20_click_clean,
        q21_null_profile,
        q22_click_profile,
        q23_click_delta,
        q24_first_last,
        q29_feature_store,
        q30_customer_matrix,
        q31_multi_loan,
        q32_snapshot_dates,
        q48_activity_profile,
        q58_stored_features,
        q59_stored_matrix,
        q60_profiles_by_month,
    )
}

WIDE_DELTA_COLUMNS = ", ".join(
    f"TRY_CAST(CAST(arg_max_null({f}, snapshot_date) AS BIGINT) - arg_min_null({f}, snapshot_date) AS INT) AS {f}_delta"
    for f in FE
)
ENDS = ", ".join(
    f"arg_min_null({f}, snapshot_date) AS {f}_first, arg_max_null({f}, snapshot_date) AS {f}_last" for f in FE
)
NULLS = ", ".join(f"count(*) - count({f}) AS {f}_nulls" for f in FE)
SILVER = ",\n".join([LOANS, CLEAN_ATTRIBUTES, CLEAN_FINANCIALS, CLICKS])

ORACLE = {
    "q20_click_clean": f"""WITH {DIRTY_CLICKS}
SELECT * FROM raw_clicks WHERE customer_id IS NOT NULL AND snapshot_date IS NOT NULL""",
    "q21_null_profile": f"WITH {DIRTY_CLICKS}\nSELECT {NULLS} FROM raw_clicks",
    "q22_click_profile": f"WITH {CLICKS}\nSELECT customer_id, {PROFILE_COLUMNS} FROM clicks GROUP BY customer_id",
    "q23_click_delta": f"""WITH {CLICKS}, wide AS (SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 19 <> 0 THEN fe_1
    WHEN month(snapshot_date) % 2 = 1 THEN 2000000000 ELSE -2000000000 END AS fe_1) FROM clicks)
SELECT customer_id, {WIDE_DELTA_COLUMNS} FROM wide GROUP BY customer_id""",
    "q24_first_last": f"WITH {CLICKS}\nSELECT customer_id, {ENDS} FROM clicks GROUP BY customer_id",
    "q29_feature_store": f"WITH {SILVER},\n{FEATURES}\nSELECT * FROM store",
    "q30_customer_matrix": f"WITH {SILVER},\n{PROFILE},\n{LOAN_FEATURES},\n{MATRIX}\nSELECT * FROM matrix",
    "q31_multi_loan": f"""WITH {SILVER},\n{FEATURES}
SELECT customer_id, count(loan_id) AS no_of_loans FROM store GROUP BY customer_id HAVING count(loan_id) > 1""",
    "q32_snapshot_dates": f"""WITH {SILVER},\n{PROFILE},\n{LOAN_FEATURES},\n{MATRIX}
SELECT DISTINCT snapshot_date FROM matrix ORDER BY snapshot_date""",
    "q48_activity_profile": f"WITH {CLICKS},\n{PROFILE}\nSELECT * FROM profile",
}
ORACLE["q58_stored_features"] = ORACLE["q29_feature_store"]
ORACLE["q60_profiles_by_month"] = ORACLE["q48_activity_profile"]
ORACLE["q59_stored_matrix"] = ORACLE["q30_customer_matrix"]
