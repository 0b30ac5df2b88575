"""Joins with hot keys give the rows of the plain join and spread the hot rows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.operators.duplicates import assert_unique, keys_with_many, shared_count, top_values, value_counts
from creditloom.operators import skew
from creditloom.operators.skew import OWNER, SALT, attach, balanced_left_join, find_hot_keys, key_code, spread
from creditloom.operators.features import activity_profile
from creditloom.plans.gold import customer_matrix, feature_store
from creditloom.queries.shape import rounded
from creditloom.sources.schemas import LOAN_AMOUNTS
from helpers import bag, final_plan_text, plan_text

KEYS = st.sampled_from(["a", "b", "c", "d", None])


def side(spark, name, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k string, {name} int")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=st.lists(KEYS, max_size=30), right=st.lists(KEYS, max_size=30), limit=st.integers(1, 6))
def test_equals_plain_join(spark, left, right, limit):
    left, right = side(spark, "x", left), side(spark, "y", right)
    ours = balanced_left_join(left, right, ["k"], rows_per_task=limit)
    assert ours.columns == ["k", "x", "y"]
    assert bag(ours) == bag(left.join(right, "k", "left"))


@pytest.mark.parametrize("hot_left, hot_right", [(600, 1), (1, 600), (40, 30), (600, 0), (0, 600)])
def test_a_key_with_most_rows_on_either_side(spark, hot_left, hot_right):
    left = side(spark, "x", ["hot"] * hot_left + ["a", "b", "c", "a"] + [None] * 50)
    right = side(spark, "y", ["hot"] * hot_right + ["a", "a", "z"])
    ours = balanced_left_join(left, right, ["k"], rows_per_task=10)
    assert bag(ours) == bag(left.join(right, "k", "left"))


def test_rows_that_are_all_alike(spark):
    left = spark.createDataFrame([("hot", 1)] * 300, "k string, x int")
    right = spark.createDataFrame([("hot", 2)] * 400, "k string, y int")
    ours = balanced_left_join(left, right, ["k"], rows_per_task=10)
    assert ours.count() == 300 * 400


def test_like_rows_are_spread_in_pieces(spark, monkeypatch):
    """A group of copies with a third of all rows, on either side, with NULLs in its columns and as its key."""
    monkeypatch.setattr(skew, "ALIKE_ROWS", 50)
    copies = spark.range(3_000).selectExpr("if(id % 3 = 0, 'hot', if(id % 7 = 0, null, cast(id as string))) k", "if(id % 3 = 0, null, 1) x")
    (hot,) = find_hot_keys((["k"], {"left": copies}), rows_per_task=100)
    dealt = spread(copies, "left", hot)
    assert bag(dealt.select("k", "x")) == bag(copies)
    for key in ("k = 'hot'", "k IS NULL"):
        sizes = [r["count"] for r in dealt.where(key).groupBy(SALT).count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 300
    few = spark.createDataFrame([("hot", 1), ("hot", 1), ("4", 2)], "k string, y int")
    assert bag(balanced_left_join(copies, few, ["k"], rows_per_task=100)) == bag(copies.join(few, "k", "left"))
    other = few.union(copies.where("k = 'hot'").selectExpr("k", "7")).toDF("k", "z")
    small = spark.createDataFrame([("hot", 1), ("4", 1), (None, 1)], "k string, x int")
    assert bag(balanced_left_join(small, other, ["k"], rows_per_task=100)) == bag(small.join(other, "k", "left"))


def test_rows_with_maps_are_dealt_by_their_other_columns(spark):
    left = spark.range(400).selectExpr("'hot' k", "id", "map('a', id) m")
    right = spark.createDataFrame([("hot", 2)], "k string, y int")
    joined = balanced_left_join(left, right, ["k"], by=["id"], rows_per_task=50)
    assert joined.count() == 400 and joined.selectExpr("sum(m['a'])").first()[0] == 399 * 200


def test_several_keys_and_shared_columns(spark):
    left = spark.createDataFrame([("a", 1, i) for i in range(60)] + [("a", 11, 0), (None, 1, 0)], "k string, n int, x int")
    right = spark.createDataFrame([("a", 1, 1), ("a", 11, 2), ("a1", 1, 3)], "k string, n int, y int")
    ours = balanced_left_join(left, right, ["k", "n"], rows_per_task=10)
    assert bag(ours) == bag(left.join(right, ["k", "n"], "left"))
    with pytest.raises(ValueError, match="both sides"):
        balanced_left_join(left, left, ["k"])


def test_codes_of_different_keys_differ(spark):
    df = spark.createDataFrame([("a", "1:b"), ("a1:", "b"), ("a1", ":b"), ("", "a"), (None, "a")], "p string, q string")
    codes = [r[0] for r in df.select(key_code(["p", "q"])).collect()]
    assert len(set(codes)) == 5 and codes[-1] is None


def test_hot_rows_are_spread_evenly(spark):
    df = spark.range(30_000).select(F.expr("if(id % 3 = 0, 'hot', cast(id as string))").alias("k"), "id")
    (hot,) = find_hot_keys((["k"], {"left": df}), rows_per_task=1_000)
    assert [(r[0], r[1], r[2]) for r in hot.table.collect()] == [("hot", "left", 10)]
    sizes = [r["count"] for r in spread(df, "left", hot).where("k = 'hot'").groupBy(SALT).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1_300
    assert spread(df, "left", hot).where("k <> 'hot'").where(F.col(SALT) != 0).count() == 0


def test_null_keys_are_spread_on_the_left(spark):
    df = spark.range(10_000).select(F.lit(None).cast("string").alias("k"), "id")
    (hot,) = find_hot_keys((["k"], {"left": df}), rows_per_task=1_000)
    assert spread(df, "left", hot).groupBy(SALT).count().count() == 10


def test_no_hot_key_means_a_plain_join(spark):
    left, right = side(spark, "x", "abc"), side(spark, "y", "abd")
    (hot,) = find_hot_keys((["k"], {"left": left, "right": right}))
    assert hot is None and spread(left, "left", hot) is left
    assert SALT not in attach(left, right, "right", ["k"], hot).columns


def test_chained_joins_owned_by_different_sides(spark):
    base = side(spark, "x", ["l"] * 80 + ["r", "s", "n", None])
    one = side(spark, "y", ["l", "r", "s"] + ["r"] * 70)
    two = side(spark, "z", ["l", "s"] + ["s"] * 60 + ["r", "r"])
    (hot,) = find_hot_keys((["k"], {"base": base, "one": one, "two": two}), rows_per_task=10)
    assert {r[0]: r[1] for r in hot.table.collect()} == {"l": "base", "r": "one", "s": "two"}
    ours = spread(base, "base", hot).transform(attach, one, "one", ["k"], hot).transform(attach, two, "two", ["k"], hot)
    assert bag(ours.drop(SALT, OWNER)) == bag(base.join(one, "k", "left").join(two, "k", "left"))


def test_shared_count_with_a_common_name(spark):
    names = ["common"] * 400 + ["rare", "twin", "twin"] + [None] * 100
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "customer_id string, name string")
    counted = shared_count(df, rows_per_task=50)
    expected = {"common": (400, 1), "rare": (1, 0), "twin": (2, 1), None: (None, 0)}
    assert {r.name: (r.name_shared_count, r.is_name_shared) for r in counted.distinct().collect()} == expected
    assert counted.count() == len(names)


def test_value_tables(spark):
    df = spark.createDataFrame([("x", 1), ("y", None), ("x", 2), (None, 3), ("y", 4), ("z", 5)], "v string, n int")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("x", 2), ("y", 2), (None, 1), ("z", 1)]
    assert [r.v for r in top_values(df, "v", 3).collect()] == ["x", "y", None]
    assert [tuple(r) for r in keys_with_many(df, "v", "n").collect()] == [("x", 2)]
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, "v")
    assert_unique(df, "n")


def test_profile_of_a_hot_customer_is_combined_from_several_tasks(spark):
    rows = spark.range(3_000).selectExpr(
        "case when id % 3 = 0 then 'whale' when id % 3 = 1 then null else string(id % 50) end customer_id",
        "date_add(date'2023-01-01', int(id)) snapshot_date",
        "int(id * 7919 % 1000) fe_1",
    )
    plain, spread_out = activity_profile(rows, ["fe_1"]), activity_profile(rows, ["fe_1"], rows_per_task=100)
    assert plan_text(plain).count("Exchange hashpartitioning") == 1
    # Rows of hot keys are combined on both sides of a shuffle of their own, the others after theirs.
    assert plan_text(spread_out).count("Exchange hashpartitioning") == 2
    assert plan_text(spread_out).count("HashAggregate") == plan_text(plain).count("HashAggregate") + 2
    columns = ["customer_id", "fe_1_min", "fe_1_max", "fe_1_delta", "round(fe_1_mean, 9)", "round(fe_1_std, 9)"]
    assert bag(plain.selectExpr(*columns)) == bag(spread_out.selectExpr(*columns))


def test_like_rows_of_a_hot_customer_are_combined_before_they_meet(spark):
    rows = spark.range(0, 5_000, 1, 10).selectExpr("'whale' customer_id", "date'2023-01-01' snapshot_date", "1 fe_1")
    profile = activity_profile(rows, ["fe_1"], rows_per_task=100)
    assert [(r.customer_id, r.fe_1_mean, r.fe_1_delta) for r in profile.collect()] == [("whale", 1.0, 0)]
    shuffled = final_plan_text(profile)
    assert "Exchange hashpartitioning" in shuffled and "partial_avg" in shuffled


def test_every_hot_key_is_found(spark):
    """More than a sketch would hold, and a few among very many single ones."""
    many = spark.range(40_000).select(F.expr("string(id % 8000)").alias("k"))
    (hot,) = find_hot_keys((["k"], {"rows": many}), rows_per_task=4)
    assert hot.table.count() == 8_000
    few = spark.range(200_000).select(F.expr("if(id < 1001, concat('hot', id % 7), string(id))").alias("k"))
    (hot,) = find_hot_keys((["k"], {"rows": few}), rows_per_task=100)
    assert sorted(r[0] for r in hot.table.collect()) == [f"hot{i}" for i in range(7)]


def test_no_limit_on_salts(spark):
    df = spark.range(5_000).select(F.lit("hot").alias("k"), "id")
    (hot,) = find_hot_keys((["k"], {"left": df}), rows_per_task=2)
    assert [r[2] for r in hot.table.collect()] == [2_500]


def test_more_hot_keys_than_may_be_listed(spark):
    left = side(spark, "x", [k for k in "abcdef" for _ in range(20)] + [None] * 30 + ["z"])
    right = side(spark, "y", [k for k in "abq" for _ in range(15)])
    (hot,) = find_hot_keys((["k"], {"left": left, "right": right}), rows_per_task=10, listed_keys=3)
    assert not hot.listed and hot.table.count() == 7
    ours = spread(left, "left", hot).transform(attach, right, "right", ["k"], hot).drop(SALT, OWNER)
    assert bag(ours) == bag(left.join(right, "k", "left"))


def test_shared_count_runs_nothing_when_built(spark):
    df = spark.createDataFrame([("1", "a")], "customer_id string, name string")
    failing = df.withColumn("name", F.raise_error(F.lit("was run")).cast("string"))
    assert shared_count(failing).columns == ["customer_id", "name", "name_shared_count", "is_name_shared"]


def test_common_names_beyond_the_listed_ones(spark):
    df = spark.createDataFrame([(str(i), "abc"[i % 3]) for i in range(90)], "customer_id string, name string")
    counted = shared_count(df, rows_per_task=5, listed_values=1)
    assert {(r.name, r.name_shared_count) for r in counted.collect()} == {("a", 30), ("b", 30), ("c", 30)}


@pytest.fixture(scope="module")
def mart(spark):
    """Silver tables where one customer holds most loans, one most attributes, and one has many clicks."""
    loans = spark.range(900).selectExpr(
        "string(id) loan_id",
        "case when id % 3 = 0 then 'whale' when id % 50 = 1 then 'attr' when id % 50 <> 2 then string(id % 40) end"
        " customer_id",
        "date'2023-01-01' loan_start_date",
        "10 tenure",
        "6 installment_num",
        *[f"float(id % 7) {c}" for c in LOAN_AMOUNTS],
        "add_months(date'2023-06-01', int(id % 3)) snapshot_date",
        "6 mob",
        "int(id % 2) installments_missed",
        "date'2023-05-01' first_missed_date",
        "31 dpd",
    )
    attribute = spark.range(40).selectExpr("string(id) customer_id", "int(id) age").unionAll(
        spark.range(300).selectExpr("case when id < 200 then 'attr' else 'ghost' end", "int(id)")
    ).unionAll(spark.createDataFrame([("whale", 1)], "customer_id string, age int"))
    financial = spark.range(30).selectExpr("string(id) customer_id", "float(id) annual_income")
    click = spark.range(40).selectExpr("string(id) customer_id", "date'2023-06-01' snapshot_date", "int(id) fe_1").unionAll(
        spark.range(400).selectExpr("if(id < 300, 'ghost', '7')", "date'2023-06-01'", "int(id)")
    )
    return loans, attribute, financial, click


def test_feature_store_with_hot_customers(mart):
    plain, spread_out = feature_store(*mart), feature_store(*mart, rows_per_task=20)
    assert plain.columns == spread_out.columns
    assert bag(plain) == bag(spread_out)
    assert plain.count() > 1_000


def test_customer_matrix_with_hot_customers(mart):
    loans, attribute, financial, click = mart
    for chosen in (loans, loans.where("customer_id <> 'attr'"), loans.where("customer_id = '1'")):
        click_and_whale = click.unionAll(click.limit(1).selectExpr("'whale'", "snapshot_date", "fe_1")).unionAll(
            click.limit(1).selectExpr("'attr'", "snapshot_date", "fe_1")
        )
        tables = (chosen, attribute, financial, click_and_whale)
        plain = customer_matrix(*tables, features=["fe_1"])
        spread_out = customer_matrix(*tables, features=["fe_1"], rows_per_task=20)
        # Clicks of one date have no order, so the delta between them is left out.
        assert bag(rounded(plain.drop("fe_1_delta"))) == bag(rounded(spread_out.drop("fe_1_delta")))
