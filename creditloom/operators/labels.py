"""Default labels and bad rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.flags import flag

# The default label definition.
DEFAULT_DPD = 30
DEFAULT_MOB = 6


def label_definition(dpd: int = DEFAULT_DPD, mob: int = DEFAULT_MOB) -> str:
    return f"{dpd}dpd_{mob}mob"


def at_month_on_book(df: DataFrame, mob: int = DEFAULT_MOB, column: str = "mob") -> DataFrame:
    return df.where(F.col(column) == mob)


def default_label(df: DataFrame, dpd: int = DEFAULT_DPD, mob: int = DEFAULT_MOB) -> DataFrame:
    """Rows at month `mob` with label 1 when at least `dpd` days past due; unknown days count as good."""
    return at_month_on_book(df, mob).withColumns(
        {"label": flag(F.col("dpd") >= dpd), "label_def": F.lit(label_definition(dpd, mob))}
    )


def dpd_flag(
    df: DataFrame,
    dpd: int = DEFAULT_DPD,
    started_before: str | dt.date | None = None,
    started: str = "loan_start_date",
) -> DataFrame:
    """Flag rows at least `dpd` days past due, over all months, for loans started before a cutoff."""
    if started_before is not None:
        df = df.where(F.col(started) < F.lit(started_before).cast("date"))
    return df.withColumn("dpd_flag", flag(F.col("dpd") >= dpd))


def bad_rate_curve(df: DataFrame, by: str = "mob", flagged: str = "dpd_flag") -> DataFrame:
    """Share of flagged rows per month on book, in order; rows without a month are left out."""
    rate = F.avg(flagged).alias("bad_rate")
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(rate).orderBy(by)


def outcomes_at(df: DataFrame, installment: int = 10, column: str = "installment_num") -> DataFrame:
    """Rows at the installment by which a loan's outcome is taken as final."""
    return df.where(F.col(column) == installment)
