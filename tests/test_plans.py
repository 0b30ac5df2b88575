"""What the physical plans must and must not hold."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__ as entry_point
from creditloom.operators.features import activity_profile, latest_per_key, loan_features
from creditloom.operators.labels import bad_rate_curve, dpd_flag
from creditloom.plans.gold import feature_store, label_store
from creditloom.queries import QUERIES
from creditloom.queries.inputs import attributes, clicks, financials
from creditloom.queries.loans import panel
from creditloom.plans.silver import silver_attributes, silver_financials
from creditloom.sources.readers import read_snapshots
from creditloom.sources.schemas import CLICK_FEATURES
from creditloom.sources.writers import write_snapshots, write_table
from helpers import plan_text

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("Python", "Pandas", "ArrowEval", "MapInArrow")


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange hashpartitioning", plan_text(df)))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("silver")
    for name, df in {"loans": panel(spark, SF), "clicks": clicks(spark, SF)}.items():
        write_snapshots(df, str(root / name))
    write_table(silver_attributes(attributes(spark, SF)), str(root / "attributes"))
    write_table(silver_financials(financials(spark, SF)), str(root / "financials"))
    return root


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_on_the_executors(spark, name):
    plan = plan_text(QUERIES[name](spark, SF))
    assert not [node for node in PYTHON_NODES if node in plan]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_label_store_reads_few_columns_of_its_months_without_a_shuffle(spark, silver):
    plan = plan_text(label_store(read_snapshots(spark, str(silver / "loans"), "1997-01-01", "1997-12-01")))
    assert "Exchange" not in plan
    assert "EqualTo(mob,6)" in plan
    assert "ReadSchema: struct<loan_id:string,customer_id:string,mob:int,dpd:int>" in plan
    assert "snapshot_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_bad_rate_curve_reads_three_columns(spark, silver):
    loans = read_snapshots(spark, str(silver / "loans"))
    plan = plan_text(bad_rate_curve(dpd_flag(loans, started_before="2000-01-01")))
    assert "ReadSchema: struct<loan_start_date:date,mob:int,dpd:int>" in plan
    assert "LessThan(loan_start_date,2000-01-01)" in plan


def test_profile_is_one_hash_aggregation(spark, silver):
    df = activity_profile(spark.read.parquet(str(silver / "clicks")), CLICK_FEATURES)
    plan = plan_text(df)
    assert exchanges(df) == 1
    assert "SortAggregate" not in plan and "Window" not in plan
    assert "Aggregate" not in plan.split("Exchange hashpartitioning", 1)[1]


def test_loan_features_shuffle_once(spark, silver):
    df = loan_features(spark.read.parquet(str(silver / "loans")))
    plan = plan_text(df)
    assert exchanges(df) == 1 and "Join" not in plan
    assert len(re.findall(r"[-+] Sort \[", plan)) <= 1
    assert "Aggregate" not in plan.split("Exchange hashpartitioning", 1)[1]  # none before the shuffle


def test_latest_row_is_cut_before_the_shuffle(spark, silver):
    plan = plan_text(latest_per_key(spark.read.parquet(str(silver / "loans")), ties=["installment_num"]))
    assert plan.count("WindowGroupLimit") == 2 and exchanges_between_limits(plan)


def exchanges_between_limits(plan: str) -> bool:
    final, partial = (m.start() for m in re.finditer("WindowGroupLimit", plan))
    return final < plan.index("Exchange hashpartitioning") < partial


def test_feature_store_moves_loans_twice_and_other_tables_once(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = feature_store(
            read_snapshots(spark, str(silver / "loans")),
            spark.read.parquet(str(silver / "attributes")),
            spark.read.parquet(str(silver / "financials")),
            read_snapshots(spark, str(silver / "clicks")),
        )
        plan = plan_text(store)
        assert exchanges(store) == 5
        assert plan.count("SortMergeJoin") == 3
        assert "EqualTo(mob,6)" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_store_reads_the_click_months_it_needs(spark, silver):
    tables = [spark.read.parquet(str(silver / name)) for name in ("loans", "attributes", "financials", "clicks")]
    plan = plan_text(feature_store(*tables, months=[dt.date(1996, 3, 1)]))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date#\d+ = 1996-03-01", plan)


def test_top_values_need_no_full_sort(spark):
    plan = plan_text(entry_point.queries()["q10_freq_topk"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
