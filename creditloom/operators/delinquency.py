"""Month on book, missed installments and days past due of a loan panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the date type: its day number is a 32-bit integer, and this is the first month that lies in it as a whole,
# counted in months from year 0.
MOST = (1 << 31) - 1
FIRST_MONTH = -5_877_641 * 12 + 6


def month_on_book(df: DataFrame, installment: str = "installment_num", out: str = "mob") -> DataFrame:
    return df.withColumn(out, F.col(installment).cast("int"))


def installments_missed(
    df: DataFrame,
    overdue: str = "overdue_amt",
    due: str = "due_amt",
    out: str = "installments_missed",
    fill: Sequence[str] | None = None,
) -> DataFrame:
    """Installments that the overdue amount stands for, rounded up; 0 where nothing is due or known.

    A number beyond the integers is the largest one, as the loan is no better for it. NULLs in numeric columns become 0 as
    well: in all of them, or only in those listed in `fill`. The ratio is taken in the column's own type, so FLOAT amounts can
    round a whole ratio up; DECIMAL amounts cannot.
    """
    ratio = F.ceil(F.try_divide(F.col(overdue), F.col(due)))
    missed = F.when(ratio > MOST, MOST).when(ratio < -MOST, -MOST).otherwise(ratio.try_cast("int"))
    counted = df.withColumn(out, missed)
    return counted.na.fill(0) if fill is None else counted.na.fill(0, subset=[out, *fill])


def days_past_due(
    df: DataFrame,
    snapshot: str = "snapshot_date",
    overdue: str = "overdue_amt",
    missed: str = "installments_missed",
    first_missed: str = "first_missed_date",
    out: str = "dpd",
) -> DataFrame:
    """Date of the first missed installment and the days since then.

    Calendar months count with their real length: one missed installment is 28 to 31 days. An overdue
    amount with nothing due has no first missed date, hence a NULL number of days. A date before the first month that the date
    type holds is put into that month, and days beyond the integers are the largest one, so such a loan stays overdue.
    """
    count, day = F.col(missed), F.col(snapshot)
    reach = F.year(day) * 12 + F.month(day) - 1 - FIRST_MONTH
    since = F.when(count > 0, F.add_months(day, -F.least(count, reach)))
    dated = df.withColumn(first_missed, since)
    days = F.unix_date(day).cast("bigint") - F.unix_date(first_missed)
    known = F.when(days > MOST, MOST).otherwise(days.try_cast("int"))
    return dated.withColumn(out, F.when(F.col(overdue) > 0, known).otherwise(0))
