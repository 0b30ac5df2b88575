"""Sinks: partitioned snapshots that can be rebuilt month by month, and whole static tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from creditloom.functions.casts import backticked
from creditloom.sources.readers import Day, children, file_system, month_headers, stored_months, within
from creditloom.sources.schemas import SNAPSHOT


OUTCOME, KEPT = "outcome", "kept"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder for a NULL


@dataclass(frozen=True)
class WriteAudit:
    """What a write put down, counted while writing."""

    rows: int
    rejected: int = 0  # rows put down as rejected
    snapshots: list[dt.date] = field(default_factory=list)


def write_snapshots(
    df: DataFrame,
    root: str,
    start: Day = None,
    end: Day = None,
    fmt: str = "parquet",
    rebalance: bool = True,
    sort_by: Sequence[str] = (),
) -> WriteAudit:
    """Write `df` partitioned by `snapshot_date`, replacing only the months it covers.

    `start` and `end` name the range being rebuilt: a month in it that has no rows any more is emptied.
    Rebalancing keeps the file count near the data size: without it every task would open a file per month.
    It splits a month larger than the advisory partition size over several tasks. Rows that already come month
    by month, as from a dataset in the same layout, need no rebalancing and then no shuffle. `sort_by` orders
    the rows of each file, so that a filter on those columns skips pages. Row count and months come from the
    final stage of the write itself, with no second job. CSV columns are put in the order of the months already there; a month may
    have more columns than those, or fewer, which `read_snapshots` unites by name.
    """
    held = stored_months(df.sparkSession, root)
    stored = {m for m in held if within(m, start, end)} if start is not None or end is not None else set()
    if fmt == "csv" and held:
        df = _in_stored_order(df, root, min(held))
    out = df.hint("rebalance", SNAPSHOT) if rebalance else df
    out = out.sortWithinPartitions(SNAPSHOT, *sort_by) if sort_by else out
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(SNAPSHOT).alias("snapshots"))
    writer = out.write.mode("overwrite").partitionBy(SNAPSHOT).option("partitionOverwriteMode", "dynamic")
    _with_header(writer, fmt).format(fmt).save(root)
    audit = WriteAudit(seen.get["rows"], snapshots=sorted(seen.get["snapshots"]))
    emptied = stored - set(audit.snapshots)
    if start is not None and not stored and not audit.snapshots:
        emptied = {dt.date.fromisoformat(str(start))}  # an empty file, so that the dataset can be read
    for month in sorted(emptied):
        empty = df.where(F.lit(False)).drop(SNAPSHOT).write.mode("overwrite")
        _with_header(empty, fmt).format(fmt).save(f"{root}/{SNAPSHOT}={month}")
    return audit


def write_outcomes(
    df: DataFrame,
    root: str,
    start: Day = None,
    end: Day = None,
    fmt: str = "parquet",
    outcome: str = OUTCOME,
    kept: str = KEPT,
) -> WriteAudit:
    """One write that parts rows by their outcome: `kept` ones, and rejected ones under the reason why, each by month.

    Below each outcome lies a dataset by `snapshot_date`, so kept rows are read as any snapshots, from `outcome_path`. Rejected rows
    without a month are replaced by every write, those with one when their month is. The audit's rows are the kept ones.
    """
    spark = df.sparkSession
    kept_path = outcome_path(root, kept, outcome)
    held = stored_months(spark, kept_path)
    if fmt == "csv" and held:
        df = _in_stored_order(df, kept_path, min(held), last=[outcome, SNAPSHOT])
    seen = Observation()
    place = F.struct(F.col(outcome).alias("outcome"), F.col(SNAPSHOT).alias("month"))
    is_kept = F.col(outcome) == kept
    out = df.hint("rebalance", outcome, SNAPSHOT).observe(
        seen, F.count_if(is_kept).alias("rows"), F.count_if(~is_kept).alias("rejected"), F.collect_set(place).alias("places")
    )
    writer = out.write.mode("overwrite").partitionBy(outcome, SNAPSHOT).option("partitionOverwriteMode", "dynamic")
    _with_header(writer, fmt).format(fmt).save(root)
    written = {(p["outcome"], p["month"]) for p in seen.get["places"]}
    for name in [x.getPath().getName().partition("=")[2] for x in children(spark, root)]:
        path = outcome_path(root, name, outcome)
        months = {month for month in stored_months(spark, path) if within(month, start, end)}
        for month in [*months, *[None] * (name != kept)]:
            if (name, month) not in written:
                system, folder = file_system(spark, f"{path}/{SNAPSHOT}={month or NO_MONTH}")
                system.delete(folder, True)
    snapshots = sorted(month for name, month in written if name == kept)
    if start is not None and not stored_months(spark, kept_path):
        empty = df.where(F.lit(False)).drop(outcome, SNAPSHOT).write.mode("overwrite")  # so that the dataset can be read
        _with_header(empty, fmt).format(fmt).save(f"{kept_path}/{SNAPSHOT}={start}")
    return WriteAudit(seen.get["rows"], seen.get["rejected"], snapshots)


def outcome_path(root: str, name: str = KEPT, outcome: str = OUTCOME) -> str:
    return f"{root}/{outcome}={name}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> WriteAudit:
    """Write a table without snapshots, replacing it as a whole."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    _with_header(writer, fmt).format(fmt).save(path)
    return WriteAudit(seen.get["rows"])


def _with_header(writer, fmt: str):
    """CSV with a header and with values as they are: Spark would trim blanks when it writes."""
    if fmt != "csv":
        return writer
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return writer.options(header=True, **kept)


def _in_stored_order(df: DataFrame, root: str, month: dt.date, last: Sequence[str] = (SNAPSHOT,)) -> DataFrame:
    """Columns of the month stored first in its order, then the others, so that months with the same columns have one header."""
    stored = month_headers(df.sparkSession, root, month, month)[month]
    rank = {name.lower(): place for place, name in enumerate(stored)}
    columns = sorted((c for c in df.columns if c not in last), key=lambda c: rank.get(c.lower(), len(rank)))
    return df.select(*[backticked(c) for c in columns], *last)
