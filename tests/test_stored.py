"""Stored key counts and bucketed tables: the rows of the plain way, without its counts and shuffles."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from creditloom.operators import key_counts
from creditloom.operators.key_counts import StoredCounts, stored_hot_keys, write_key_counts
from creditloom.operators.skew import find_hot_keys
from creditloom.plans.backfill import Mart, backfill, bucket_count, feature_hot_keys, matrix_hot_keys, silver_table, stored_features, stored_matrix, write_silver_table
from creditloom.plans.gold import customer_matrix, feature_store
from creditloom.queries import QUERIES, stores
from creditloom.queries.inputs import attributes, clicks, financials
from creditloom.queries.loans import panel
from creditloom.queries.shape import rounded
from creditloom.plans.silver import silver_attributes, silver_financials
from creditloom.sources.buckets import read_buckets, write_buckets
from creditloom.sources.readers import children, stored_months
from creditloom.sources.schemas import LOAN_AMOUNTS
from helpers import bag, plan_text
from test_backfill import mart, source  # noqa: F401

SF = "/root/testdata/sf0.001"
JAN, FEB, MAR = (dt.date(2023, m, 1) for m in (1, 2, 3))


def jobs_of(spark, build):
    """The value, and how many jobs ran while it was built."""
    context = spark.sparkContext
    context.setJobGroup("counted", "")
    before = len(context.statusTracker().getJobIdsForGroup("counted"))
    value = build()
    after = len(context.statusTracker().getJobIdsForGroup("counted"))
    context.setLocalProperty("spark.jobGroup.id", None)
    return value, after - before


def rows_of(spark, *counts):
    """Rows of (customer, month, how many)."""
    data = [(c, m, n) for c, m, n in counts]
    df = spark.createDataFrame(data, "customer_id string, snapshot_date date, n int")
    return df.select("customer_id", "snapshot_date", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("loan_id"))


def stored(spark, counts, key="customer"):
    df = counts.read(spark, key)
    return sorted((tuple(r) for r in df.select("code", "rows", "snapshot_date").collect()), key=str)


def test_counts_of_frequent_keys_by_month(spark, tmp_path):
    root, keys = str(tmp_path / "counts"), {"customer": "customer_id", "loan": "loan_id"}
    rows = rows_of(spark, ("a", JAN, 9), ("b", JAN, 3), ("a", FEB, 4), (None, FEB, 7), ("a", MAR, 1))
    write_key_counts(rows, root, keys, 3, JAN, MAR)
    assert stored(spark, StoredCounts(root, 3, 3)) == [("a", 4, FEB), ("a", 9, JAN), (None, 7, FEB)]
    assert stored(spark, StoredCounts(root, 1, 3, JAN, JAN)) == [("a", 9, JAN)]
    assert StoredCounts(root, 1, 3, MAR, MAR).read(spark, "customer") is None
    assert stored_months(spark, root) == {JAN, FEB}
    # A month is replaced, also by nothing.
    write_key_counts(rows_of(spark, ("c", FEB, 5)), root, keys, 3, FEB, FEB)
    assert stored(spark, StoredCounts(root, 3, 3)) == [("a", 9, JAN), ("c", 5, FEB)]
    write_key_counts(rows_of(spark, ("c", FEB, 2)), root, keys, 3, JAN, FEB)
    assert children(spark, root) == [] and StoredCounts(root, 3, 3).read(spark, "customer") is None


@pytest.mark.parametrize("slots, listed", [(1, 100), (4, 100), (1 << 14, 100), (4, 2)])
def test_counts_by_slot_first_are_those_of_a_plain_count(spark, tmp_path, monkeypatch, slots, listed):
    """Keys that share a slot, a NULL key and rows without a month, also with more full slots than may be listed."""
    monkeypatch.setattr(key_counts, "SLOTS", slots)
    monkeypatch.setattr(key_counts, "LISTED_KEYS", listed)
    root = str(tmp_path / "counts")
    rows = rows_of(spark, *[(f"c{k}", m, n) for k in range(40) for m, n in ((JAN, k % 7), (FEB, 1))], (None, FEB, 9), ("c1", MAR, 8))
    write_key_counts(rows, root, {"customer": "customer_id", "loan": "loan_id"}, 3, JAN, MAR)
    plain = rows.groupBy("customer_id", "snapshot_date").count().where("count > 3")
    assert stored(spark, StoredCounts(root, 3, 3)) == sorted(((r[0], r[2], r[1]) for r in plain.collect()), key=str)
    loans = {r[0]: r[1] for r in rows.groupBy("loan_id").count().collect()}
    assert {r[0] for r in stored(spark, StoredCounts(root, 3, 3), "loan")} == {str(k) for k, n in loans.items() if n > 3}


def test_keys_below_the_floor_are_not_counted_one_by_one(spark, tmp_path):
    """The shuffle of a table without frequent keys holds slots, not keys."""
    rows = spark.range(200_000, numPartitions=1).select(F.col("id").cast("string").alias("customer_id"), F.lit(JAN).alias("snapshot_date"))
    by = ["snapshot_date", "key"]
    listed = rows.select("snapshot_date", F.lit("customer").alias("key"), F.col("customer_id").alias("code"))
    assert key_counts._in_full_slots(listed, by, 3_000).count() == 0
    assert key_counts._in_full_slots(listed, by, 5).select("code").distinct().count() > 100_000


def test_counts_without_months(spark, tmp_path):
    root = str(tmp_path / "counts")
    rows = rows_of(spark, ("a", JAN, 9), ("b", FEB, 3))
    write_key_counts(rows, root, {"customer": "customer_id"}, 3, monthly=False)
    assert [tuple(r) for r in StoredCounts(root, floor=3).read(spark, "customer").collect()] == [("a", 9)]
    write_key_counts(rows, root, {"customer": "customer_id"}, 10, monthly=False)
    assert StoredCounts(root, floor=10).read(spark, "customer") is None


@pytest.mark.parametrize("floor", [0, 2])
def test_merged_counts_find_the_hot_keys(spark, tmp_path, floor):
    """With no floor just those of a count over the rows; with one, at least those."""
    root = str(tmp_path / "counts")
    rows = rows_of(spark, ("a", JAN, 6), ("a", FEB, 6), ("b", JAN, 2), ("b", FEB, 2), ("c", MAR, 11), (None, JAN, 30))
    write_key_counts(rows, root, {"customer": "customer_id"}, floor, JAN, MAR)
    side = {"rows": (StoredCounts(root, 3, floor), "customer")}
    joins = [(["customer_id"], side), (["customer_id", "snapshot_date"], side)]
    total, monthly = stored_hot_keys(spark, joins, rows_per_task=10)
    for mine, keys in ((total, ["customer_id"]), (monthly, ["customer_id", "snapshot_date"])):
        (counted,) = find_hot_keys((keys, {"rows": rows}), rows_per_task=10)
        codes = lambda hot: {r[0] for r in hot.table.collect()}
        assert codes(mine) >= codes(counted) if floor else codes(mine) == codes(counted)
        assert set(mine.null_salts) == set(counted.null_salts) or keys[-1] == "snapshot_date"
    assert stored_hot_keys(spark, joins, rows_per_task=floor * 3 - 1) is None if floor else True


def test_no_frequent_key_means_no_job(spark, tmp_path):
    root = str(tmp_path / "counts")
    write_key_counts(rows_of(spark, ("a", JAN, 2)), root, {"customer": "customer_id"}, 3, JAN, JAN)
    joins = [(["customer_id"], {"rows": (StoredCounts(root, 1, 3), "customer")})]
    assert jobs_of(spark, lambda: stored_hot_keys(spark, joins)) == ([None], 0)


def test_buckets_hold_the_rows_and_replace_months(spark, tmp_path):
    path = str(tmp_path / "it's [a] table")
    rows = rows_of(spark, ("a", JAN, 5), ("b", JAN, 3), ("c", FEB, 4), (None, MAR, 2))
    audit = write_buckets(rows, path, 4, start=JAN, end=MAR)
    assert (audit.rows, audit.snapshots) == (14, [JAN, FEB, MAR])
    assert bag(read_buckets(spark, path)) == bag(rows)
    write_buckets(rows_of(spark, ("d", FEB, 7)).withColumn("extra", F.lit(1)), path, 4, start=FEB, end=MAR)
    found = read_buckets(spark, path)
    assert {(r.customer_id, r.extra, r["count"]) for r in found.groupBy("customer_id", "extra").count().collect()} == {("a", None, 5), ("b", None, 3), ("d", 1, 7)}
    assert read_buckets(spark, path, JAN, JAN).count() == 8
    write_buckets(spark.sql("SELECT 'a' customer_id, 1 x"), str(tmp_path / "static"), 4, monthly=False)
    write_buckets(spark.sql("SELECT 'b' customer_id, 2 x"), str(tmp_path / "static"), 4, monthly=False)
    assert [tuple(r) for r in read_buckets(spark, str(tmp_path / "static")).collect()] == [("b", 2)]


def test_empty_buckets(spark, tmp_path):
    path = str(tmp_path / "empty")
    write_buckets(rows_of(spark, ("a", JAN, 1)).where("1 = 0"), path, 4, start=JAN, end=JAN)
    assert read_buckets(spark, path).columns == ["customer_id", "loan_id", "snapshot_date"]
    assert read_buckets(spark, path).collect() == []


@pytest.fixture(scope="module")
def tables(spark):
    return panel(spark, SF), silver_attributes(attributes(spark, SF)), silver_financials(financials(spark, SF)), clicks(spark, SF)


NAMES = ("lms_loan_daily", "features_attributes", "features_financials", "feature_clickstream")


def store(spark, tmp_path_factory, tables, **options):
    root = str(tmp_path_factory.mktemp("mart"))
    stored_mart = Mart("", root, "1990-01-01", "2005-12-01", **options)
    for name, df in zip(NAMES, tables, strict=True):
        write_silver_table(stored_mart, name, df, ["customer_id"])
    return stored_mart


@pytest.fixture(scope="module")
def bucketed(spark, tables, tmp_path_factory):
    return store(spark, tmp_path_factory, tables, buckets=4)


def without_broadcasts(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_store_over_buckets_has_no_exchange_and_no_job(spark, bucketed):
    def plan():
        df, jobs = jobs_of(spark, lambda: stored_features(spark, bucketed))
        return plan_text(df), jobs

    text, jobs = without_broadcasts(spark, plan)
    assert jobs == 0
    assert "Exchange" not in text and text.count("SortMergeJoin") == 3
    assert len(re.findall(r"Bucketed: true", text)) == 4 or "SelectedBucketsCount" in text


def test_matrix_over_buckets_moves_the_aggregated_tables_only(spark, bucketed):
    def plan():
        df, jobs = jobs_of(spark, lambda: stored_matrix(spark, bucketed))
        return plan_text(df), jobs

    text, jobs = without_broadcasts(spark, plan)
    # Loans by loan, their features by customer, clicks by customer and for the last join; the two customer tables stay where they are.
    assert jobs == 0 and len(re.findall(r"Exchange hashpartitioning", text)) <= 4


def test_tasks_of_the_matrix_over_buckets_are_the_buckets(spark, bucketed):
    """Also the aggregations and the last join, whatever the session's number of partitions; clicks stay where they are."""
    text = without_broadcasts(spark, lambda: plan_text(stored_matrix(spark, bucketed)))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\d+)\)", text) == [("customer_id", "4"), ("loan_id", "4")]


def test_stores_over_buckets_equal_plain_ones(spark, tables, bucketed):
    amounts = lambda df: df.drop(*LOAN_AMOUNTS)
    assert bag(amounts(stored_features(spark, bucketed))) == bag(amounts(feature_store(*tables)))
    assert bag(amounts(rounded(stored_matrix(spark, bucketed)))) == bag(amounts(rounded(customer_matrix(*tables))))


@pytest.mark.parametrize("options", [{"buckets": 4}, {}, {"count_floor": 1000}])
def test_hot_customers_leave_the_buckets(spark, tables, tmp_path_factory, options):
    """A customer with a third of the loans: found by the stored counts, spread, and not read by bucket."""
    loans, one, two, three = tables
    third = F.when(F.col("loan_id").cast("bigint") % 3 == 0, "1").otherwise(F.col("customer_id")).alias("customer_id")
    hot_loans = loans.select(*[third if c == "customer_id" else c for c in loans.columns])
    hot_mart = store(spark, tmp_path_factory, (hot_loans, one, two, three), **{"rows_per_task": 100, "count_floor": 0, **options})
    found = feature_hot_keys(spark, hot_mart)
    if "count_floor" in options:  # too high for the months to tell all hot keys
        assert found is None and matrix_hot_keys(spark, hot_mart) is None
    else:
        assert "1" in {r[0] for r in found[1].table.collect()}
        assert "SelectedBucketsCount" not in plan_text(stored_features(spark, hot_mart))
    amounts = lambda df: df.drop(*LOAN_AMOUNTS)
    plain = feature_store(hot_loans, one, two, three)
    assert bag(amounts(stored_features(spark, hot_mart))) == bag(amounts(plain))
    assert bag(amounts(rounded(stored_matrix(spark, hot_mart)))) == bag(amounts(rounded(customer_matrix(hot_loans, one, two, three))))


def test_bucketed_mart_equals_the_plain_one(spark, mart, tmp_path):  # noqa: F811
    backfill(spark, mart)
    other = replace(mart, root=str(tmp_path / "buckets"), buckets=3)
    for month in ("2023-06-01", "2023-07-01", "2023-08-01"):
        backfill(spark, replace(other, start=month, end=month))
    for name in ("label_store", "feature_store"):
        assert bag(spark.read.parquet(other.path("gold", name))) == bag(spark.read.parquet(mart.path("gold", name)))
    assert bag(silver_table(spark, other, "features_attributes")) == bag(silver_table(spark, mart, "features_attributes"))
    early = replace(other, start="2022-01-01", end="2022-03-01")
    assert backfill(spark, early)["gold/feature_store"].rows == 0


def test_buckets_grow_with_the_rows(spark, monkeypatch, tmp_path):
    """A bucket holds about as many rows however large the tables are."""
    assert [bucket_count(n) for n in (0, 8_000_000, 8_000_001, 240_000_000)] == [8, 8, 9, 240]
    monkeypatch.setattr(stores, "bucket_count", lambda rows: bucket_count(rows, 500))
    few, many = (stores._stored_mart(spark, f"/root/testdata/{sf}", "test") for sf in ("sf0.001", "sf0.01"))
    assert few.buckets < many.buckets
    assert bag(rounded(stored_features(spark, many))) == bag(rounded(QUERIES["q29_feature_store"](spark, "/root/testdata/sf0.01")))
