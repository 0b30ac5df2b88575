"""What several runs share: vocabularies that grow, publication as a whole, and rejected rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from creditloom.__main__ import main
from creditloom.operators.vocabulary import extend_vocabularies, read_encoded, stored_vocabularies
from creditloom.plans import backfill as plans
from creditloom.plans.backfill import backfill, bronze_table, feature_months, rejected_rows
from creditloom.plans.publish import manifest, months_of, publish, published, remove_unused
from creditloom.queries import loans, relations
from creditloom.queries.inputs import loan_panel
from creditloom.session import side_by_side
from creditloom.sources.files import newest, numbered, read_json, write_json
from creditloom.sources.readers import children, read_snapshots
from creditloom.sources.writers import outcome_path, write_outcomes, write_snapshots
from helpers import bag
from test_backfill import ATTRIBUTES, CLICKS, FINANCIALS, LOANS, mart, source  # noqa: F401

JULY, AUGUST = dt.date(2023, 7, 1), dt.date(2023, 8, 1)


def test_vocabularies_only_grow(spark, tmp_path):
    root = str(tmp_path / "vocabulary")
    assert stored_vocabularies(spark, root) == {}
    assert extend_vocabularies(spark, root, {"items": ["b", "a"], "other": []}) == {"items": ["a", "b"], "other": []}
    assert extend_vocabularies(spark, root, {"items": ["b", "aa", "0"]}) == {"items": ["a", "b", "0", "aa"], "other": []}
    assert extend_vocabularies(spark, root, {"items": ["a"]}) == stored_vocabularies(spark, root)
    assert newest(spark, root)[0] == 2  # nothing new, no version
    assert stored_vocabularies(spark, root, version=1) == {"items": ["a", "b"], "other": []}
    with pytest.raises(ValueError, match="more than 4 distinct values of items"):
        extend_vocabularies(spark, root, {"items": ["x", "y"]}, limit=4)
    assert newest(spark, root)[0] == 2
    with pytest.raises(FileExistsError):  # two runs that extend the same version
        write_json(spark, numbered(root, 2), {}, replace=False)
    assert [x.getPath().getName() for x in children(spark, root)] == ["00000001.json", "00000002.json"]


def test_json_files_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "folder" / "x.json")
    assert read_json(spark, path) is None and newest(spark, str(tmp_path / "folder")) == (0, None)
    write_json(spark, path, {"a": ["ü", 1, None]})
    write_json(spark, path, [2])
    assert read_json(spark, path) == [2] and len(list((tmp_path / "folder").glob("[!.]*"))) == 1


def test_old_months_read_zero_for_new_values(spark, tmp_path):
    root = str(tmp_path / "months")
    first = spark.createDataFrame([("a", 1, 1, 0), ("b", 0, 0, None), ("c", None, None, None)], "id string, has_valid_payment_behavior int, auto_loan int, pb_low int")
    later = spark.createDataFrame([("d", 1, 0, 1, 1, 0)], "id string, has_valid_payment_behavior int, auto_loan int, new_loan int, pb_high int, pb_low int")
    write_snapshots(first.withColumn("snapshot_date", F.lit(JULY)), root)
    write_snapshots(later.withColumn("snapshot_date", F.lit(AUGUST)), root)
    rows = read_encoded(spark, root, ["Auto Loan", "New-Loan", "Never"], ["low", "High"])
    assert rows.columns == ["id", "has_valid_payment_behavior", "auto_loan", "new_loan", "never", "pb_low", "pb_high", "snapshot_date"]
    found = {r.id: tuple(r)[2:-1] for r in rows.collect()}
    assert found == {"a": (1, 0, 0, 0, 0), "b": (0, 0, 0, None, None), "c": (None,) * 5, "d": (0, 1, 0, 0, 1)}


def test_runs_with_a_new_loan_type_between_them(spark, mart, source):  # noqa: F811
    july, august = (replace(mart, start=m, end=m) for m in (str(JULY), str(AUGUST)))
    backfill(spark, july)
    before = spark.read.parquet(mart.path("silver", "features_financials")).columns
    changed = FINANCIALS.replace('"Auto Loan, and Payday Loan"', '"Aaa Loan, Student Loan"').replace("High_spent", "Average")
    extra = FINANCIALS.splitlines()[1].replace("C1,", "C9,", 1).replace('"Auto Loan, and Payday Loan"', "Boat-Loan").replace("High_spent", "Tiny")
    (source / "features_financials.csv").write_text(changed + extra + "\n")
    backfill(spark, august)
    after = spark.read.parquet(mart.path("silver", "features_financials")).columns
    place = after.index("auto_loan")
    assert after[place : place + 5] == ["auto_loan", "payday_loan", "aaa_loan", "boat_loan", "student_loan"]
    assert [c for c in after if c in before] == before
    rows = {(r.loan_id, r.snapshot_date): r for r in feature_months(spark, mart).collect()}
    old, new = rows["L1", JULY], rows["L3", AUGUST]
    assert (old.auto_loan, old.payday_loan, old.boat_loan, old.student_loan, old.pb_high_spent, old.pb_tiny) == (1, 1, 0, 0, 1, 0)
    assert (new.auto_loan, new.boat_loan, new.pb_high_spent, new.pb_tiny) == (0, 1, 0, 1)


def labels(spark, mart):  # noqa: F811
    return {r.loan_id: r.label for r in published(spark, mart.root, "gold/label_store").collect()}


def test_a_failed_run_leaves_the_old_state_and_resumes(spark, mart, source, monkeypatch):  # noqa: F811
    audits = publish(spark, mart, "one")
    assert audits["gold/label_store"].rows == 3 and labels(spark, mart) == {"L1": 1, "L2": 0, "L3": 1}
    (source / "lms_loan_daily.csv").write_text(LOANS.replace("0,100,500,2023-07-01", "100,0,500,2023-07-01"))
    july = replace(mart, start="2023-07-01", end="2023-07-01")

    def fails(spark, mart):  # noqa: F811
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(plans, "build_gold", fails)
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, july, "two")
    assert labels(spark, mart) == {"L1": 1, "L2": 0, "L3": 1} and len(children(spark, f"{mart.root}/manifests")) == 1
    with pytest.raises(ValueError, match="begun with"):
        publish(spark, replace(july, end="2023-08-01"), "two")
    # The layers that were complete are not built again, whatever has become of the source.
    (source / "lms_loan_daily.csv").write_text("gone")
    with monkeypatch.context() as patched:
        patched.setattr(plans, "build_bronze", fails)
        patched.setattr(plans, "build_silver", fails)
        resumed = publish(spark, july, "two")
    assert resumed["bronze/lms_loan_daily"].rows == 2 and resumed["gold/label_store"].snapshots == [JULY]
    assert labels(spark, mart) == {"L1": 0, "L2": 0, "L3": 1}
    names = manifest(spark, mart.root)["gold/label_store"]
    assert names == {"2023-06-01": "one", "2023-07-01": "two", "2023-08-01": "one"}
    assert published(spark, mart.root, "gold/label_store", "2023-07-01", "2023-07-31").count() == 2
    assert manifest(spark, mart.root)["silver/features_attributes"] == {"": "two"}
    assert published(spark, mart.root, "silver/features_attributes").count() == 2


def test_unused_runs_are_removed_and_months_without_rows_are_taken_over(spark, mart, source):  # noqa: F811
    publish(spark, mart, "one")
    (source / "lms_loan_daily.csv").write_text("\n".join(LOANS.splitlines()[:-2]) + "\n")
    publish(spark, mart, "two")
    assert labels(spark, mart) == {"L1": 1, "L2": 0}  # August has no rows any more
    assert remove_unused(spark, mart.root, keep=2) == []
    assert remove_unused(spark, mart.root) == ["one"] and labels(spark, mart) == {"L1": 1, "L2": 0}
    with pytest.raises(FileNotFoundError, match="not published"):
        published(spark, mart.root, "gold/nothing")


def test_command_line_publishes_a_run(spark, mart, monkeypatch, capsys):  # noqa: F811
    options = {"source": mart.source, "root": mart.root, "start": "2023-06-01", "end": "2023-08-01", "run": "one", "buckets": "2"}
    monkeypatch.setattr("sys.argv", ["creditloom", *[part for k, v in options.items() for part in (f"--{k}", v)]])
    main()
    assert "gold/label_store: 3 rows" in capsys.readouterr().out
    assert labels(spark, mart) == {"L1": 1, "L2": 0, "L3": 1}


def test_months_of_a_range(mart):  # noqa: F811
    assert months_of(mart) == ["2023-06-01", "2023-07-01", "2023-08-01"]
    assert months_of(replace(mart, start="2022-11-15", end="2023-02-10")) == ["2022-12-01", "2023-01-01", "2023-02-01"]


def test_rejected_rows_are_kept_with_a_reason(spark, mart, source):  # noqa: F811
    lines = LOANS.splitlines()
    odd = [lines[1].replace("2023-06-01", "").replace("L1", "L7"), lines[1].replace("2023-06-01", "June").replace("L1", "L8")]
    (source / "lms_loan_daily.csv").write_text("\n".join([*lines, *odd]) + "\n")
    audits = backfill(spark, mart)
    assert (audits["bronze/lms_loan_daily"].rows, audits["bronze/lms_loan_daily"].rejected) == (4, 3)
    found = {(r.loan_id, r.outcome, r.snapshot_date, r.snapshot_text) for r in rejected_rows(spark, mart, "lms_loan_daily").collect()}
    assert found == {("L4", "within_month", AUGUST, "2023-08-15"), ("L7", "no_date", None, None), ("L8", "unreadable_date", None, "June")}
    assert "snapshot_text" not in bronze_table(spark, mart, "lms_loan_daily").columns
    # A rebuilt month replaces its rejected rows and those without a month.
    (source / "lms_loan_daily.csv").write_text(LOANS.replace("2023-08-15", "2023-08-01"))
    backfill(spark, replace(mart, start="2023-08-01", end="2023-08-01"))
    assert rejected_rows(spark, mart, "lms_loan_daily").count() == 0
    assert sorted(r.loan_id for r in bronze_table(spark, mart, "lms_loan_daily").collect()) == ["L1", "L1", "L2", "L3", "L4"]


def test_outcomes_of_one_write(spark, tmp_path):
    root = str(tmp_path / "parted")
    rows = spark.createDataFrame([("a", "kept", JULY), ("b", "bad", None), ("c", "bad", JULY), ("d", "kept", AUGUST)], "k string, outcome string, snapshot_date date")
    audit = write_outcomes(rows, root, JULY, AUGUST)
    assert (audit.rows, audit.rejected, audit.snapshots) == (2, 2, [JULY, AUGUST])
    assert bag(read_snapshots(spark, outcome_path(root)).select("k")) == {("a",): 1, ("d",): 1}
    write_outcomes(rows.where("k in ('a', 'b')"), root, JULY, JULY)
    assert {(r.k, r.outcome) for r in spark.read.parquet(root).collect()} == {("a", "kept"), ("d", "kept"), ("b", "bad")}
    empty = str(tmp_path / "nothing")
    assert write_outcomes(rows.where("1 = 0"), empty, JULY, AUGUST).rows == 0
    assert read_snapshots(spark, outcome_path(empty)).columns == ["k", "snapshot_date"]


def test_parts_run_side_by_side(spark):
    met, ended = Barrier(2, timeout=60), []

    def fails():
        met.wait()
        raise RuntimeError("lost")

    def lasts():
        met.wait()
        ended.append(spark.range(100).count())

    with pytest.raises(RuntimeError, match="lost"):
        side_by_side(spark, {"one": fails, "two": lasts})
    assert ended == [100]
    assert side_by_side(spark, {"b": lambda: 1, "a": lambda: 2}) == {"b": 1, "a": 2}


def test_layers_build_their_tables_side_by_side(spark, mart, source, monkeypatch):  # noqa: F811
    """All four tables of a layer are under way before any is written."""
    for layer, writers in (("bronze", ("write_table", "write_outcomes")), ("silver", ("write_table", "write_snapshots"))):
        met = Barrier(4, timeout=60)

        def waiting(write):
            return lambda *a, **b: (met.wait(), write(*a, **b))[1]

        with monkeypatch.context() as patched:
            for name in writers:
                patched.setattr(plans, name, waiting(getattr(plans, name)))
            audits = getattr(plans, f"build_{layer}")(spark, mart)
        assert [name.partition("/")[2] for name in audits][:2] == ["features_attributes", "features_financials"] and len(audits) == 4


def test_sources_tell_their_months_while_they_are_written(spark, tmp_path, monkeypatch):
    sf = "/root/testdata/sf0.001"
    expected = relations._range(loan_panel(spark, sf))
    monkeypatch.setattr(relations, "loan_panel", None)  # no second computation of the panel
    assert relations._write_sources(spark, sf, str(tmp_path / "source")) == expected


def test_loan_states_are_written_where_they_lie(spark, monkeypatch):
    sf, plain, seen = "/root/testdata/sf0.001", loans.write_snapshots, []
    monkeypatch.setattr(loans, "write_snapshots", lambda *a, **b: (seen.append(b.get("rebalance", True)), plain(*a, **b))[1])
    assert bag(loans.q61_loans_by_month(spark, sf)) == bag(loans.q28_loan_features(spark, sf))
    assert seen == [False, False]
