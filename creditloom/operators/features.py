"""Per-loan and per-customer features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.casts import backticked
from creditloom.functions.dates import vintage
from creditloom.functions.flags import flag
from creditloom.operators.skew import ROWS_PER_TASK, HotKeys, grouped

VINTAGES = ["old", "mid", "new"]
# Columns of a loan's latest row that are no features.
NOT_FEATURES = ("due_amt", "loan_start_date", "paid_amt", "first_missed_date")


def risk_flags(df: DataFrame, overdue: str = "overdue_amt", first_missed: str = "first_missed_date") -> DataFrame:
    return df.withColumns(
        {
            "has_overdue_amt": flag(F.col(overdue) > 0),
            "has_missed_payment": flag(F.col(first_missed).isNotNull()),
        }
    )


def _totals(paid: str = "paid_amt", overdue: str = "overdue_amt", snapshot: str = "snapshot_date") -> list[Column]:
    return [
        F.sum(paid).alias("total_paid_amt"),
        F.count_if(F.col(overdue) > 0).alias("num_months_overdue"),
        F.max(snapshot).alias("latest_snapshot_date"),
    ]


def loan_totals(df: DataFrame, key: str = "loan_id") -> DataFrame:
    """Amount paid, months overdue and latest snapshot per loan."""
    return df.groupBy(key).agg(*_totals())


def latest_per_key(
    df: DataFrame, key: str | Sequence[str] = "loan_id", order: str = "snapshot_date", ties: Sequence[str] = ()
) -> DataFrame:
    """The latest row of every key; `ties` orders rows of the same date.

    The rank is alone in its window, so Spark keeps one row per key and task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(c) for c in ties])
    ranked = df.withColumn("__rank", F.row_number().over(newest_first))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def loan_vintage(df: DataFrame, key: str = "loan_id", started: str = "loan_start_date") -> DataFrame:
    """Start date, latest snapshot, vintage, start month and start year per loan."""
    spans = df.groupBy(key).agg(
        F.min(started).alias("loan_start_date"), F.max("snapshot_date").alias("latest_snapshot_date")
    )
    return spans.withColumns(
        {
            "loan_vintage": vintage(F.col("latest_snapshot_date"), F.col("loan_start_date")),
            "loan_start_month": F.month("loan_start_date"),
            "loan_start_year": F.year("loan_start_date"),
        }
    )


def vintage_flags(df: DataFrame, column: str = "loan_vintage") -> DataFrame:
    return df.withColumns({f"{column}_{name}": flag(F.col(column) == name) for name in VINTAGES})


def loan_features(
    df: DataFrame,
    key: str = "loan_id",
    order: str = "snapshot_date",
    owner: str = "customer_id",
    exclude: Sequence[str] = NOT_FEATURES,
    rows_per_task: int = ROWS_PER_TASK,
    hot: HotKeys | None | bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """One row per loan over its whole history: latest state, totals, vintage, start date parts and flags.

    One aggregation serves all of it. The latest row is the maximum of a struct that starts with the date
    and the customer and holds every column, which is a total order. Structs with text can't be aggregated by
    hash, so rows are shuffled first and sorted once. The start date is the earliest known of the loan.
    """
    folded = grouped(df, key, loan_aggregates(df.columns, key, order, owner), rows_per_task, hot, tasks)
    return loan_columns(folded, key, exclude)


def loan_aggregates(columns: Sequence[str], key: str = "loan_id", order: str = "snapshot_date", owner: str = "customer_id") -> list[Column]:
    """What `loan_columns` needs of a loan's rows."""
    rest = [owner, *[c for c in columns if c not in (key, order, owner)]]
    newest = F.max(F.struct(*[backticked(c) for c in [order, *rest]])).alias("__newest")
    return [newest, *_totals(snapshot=order), F.min("loan_start_date").alias("__started")]


def loan_columns(folded: DataFrame, key: str, exclude: Sequence[str]) -> DataFrame:
    columns = folded.schema["__newest"].dataType.names
    wide = folded.select(
        key,
        *[F.col("__newest").getField(c).alias(c) for c in columns],
        "total_paid_amt",
        "num_months_overdue",
        vintage(F.col("latest_snapshot_date"), F.col("__started")).alias("loan_vintage"),
        F.month("__started").alias("loan_start_month"),
        F.year("__started").alias("loan_start_year"),
    )
    return wide.transform(vintage_flags).transform(risk_flags).drop("loan_vintage", *exclude)


def latest_owner(
    df: DataFrame, key: str = "loan_id", order: str = "snapshot_date", owner: str = "customer_id"
) -> DataFrame:
    """Customer of each loan's latest row, the same as in `loan_features` but from three columns only."""
    latest = latest_per_key(df.select(key, order, owner), key, order, ties=[owner])
    return latest.select(key, owner)


def _statistics(columns: Sequence[str]) -> list[Column]:
    parts = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return [function(c).alias(f"{c}_{name}") for c in columns for name, function in parts.items()]


def _ends(columns: Sequence[str], order: str, ties: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    by = F.struct(order, *ties) if ties else F.col(order)
    return {c: F.min_by(c, by) for c in columns}, {c: F.max_by(c, by) for c in columns}


def _deltas(columns: Sequence[str], order: str, ties: Sequence[str]) -> list[Column]:
    first, last = _ends(columns, order, ties)
    return [F.try_subtract(last[c], first[c]).alias(f"{c}_delta") for c in columns]


def first_last(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "customer_id",
    order: str = "snapshot_date",
    ties: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Value at the first and at the last date per key, NULL included. No window and no sort are needed."""
    first, last = _ends(columns, order, ties)
    ends = [e for c in columns for e in (first[c].alias(f"{c}_first"), last[c].alias(f"{c}_last"))]
    return grouped(df, key, ends, rows_per_task)


def first_last_delta(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "customer_id",
    order: str = "snapshot_date",
    ties: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Last minus first value per key; NULL where that overflows."""
    return grouped(df, key, _deltas(columns, order, ties), rows_per_task)


def activity_statistics(
    df: DataFrame, columns: Sequence[str], key: str = "customer_id", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum of every column per key."""
    return grouped(df, key, _statistics(columns), rows_per_task)


def activity_profile(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "customer_id",
    order: str = "snapshot_date",
    ties: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    hot: HotKeys | None | bool = True,
    placed: bool = False,
) -> DataFrame:
    """Statistics and last-minus-first deltas together, in one aggregation with one shuffle, or none if rows are `placed` in buckets by key.

    The result of a key is many times as wide as a row, so rows are shuffled and then aggregated.
    """
    return grouped(df, key, [*_statistics(columns), *_deltas(columns, order, ties)], rows_per_task, hot, placed=placed)


def snapshot_dates(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Distinct dates in order."""
    return df.select(column).distinct().orderBy(column)
