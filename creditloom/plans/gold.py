"""Gold tables: label store, feature store per snapshot, and the customer matrix over the whole history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.features import activity_profile, latest_owner, loan_features, risk_flags
from creditloom.operators.labels import DEFAULT_DPD, DEFAULT_MOB, at_month_on_book, default_label
from creditloom.operators.skew import CODE, OWNER, ROWS_PER_TASK, SALT, HotKeys, attach, find_hot_keys, spread
from creditloom.sources.schemas import CLICK_FEATURES, CUSTOMER, SNAPSHOT

# Columns that do not reach the feature store.
LOAN_COLUMNS_DROPPED = ["due_amt", "loan_start_date", "paid_amt", "first_missed_date", "mob", "dpd"]
FINANCIAL_COLUMNS_DROPPED = [
    "credit_mix",
    "payment_behaviour",
    "credit_history_years",
    "credit_history_months",
    "snapshot_date",
]


def label_store(loans: DataFrame, dpd: int = DEFAULT_DPD, mob: int = DEFAULT_MOB) -> DataFrame:
    labelled = default_label(loans, dpd, mob)
    return labelled.select("loan_id", CUSTOMER, "label", "label_def", SNAPSHOT)


def feature_store(
    loans: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    clicks: DataFrame,
    mob: int = DEFAULT_MOB,
    exclude: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    months: Sequence[dt.date] | None = None,
    hot: Sequence[HotKeys | None] | None = None,
) -> DataFrame:
    """Loans at month `mob` with the customer's attributes, financials and clicks of the same snapshot.

    All snapshots are built at once: the click join has the snapshot in its key. It comes first, while the
    rows are narrow; the two customer tables follow on one key, so loans move twice and no table more than
    once. `months` are those with such loans, if known, as from the write of the label store; other click
    months are then not read. Keys with more than `rows_per_task` rows in any table are spread over tasks; `hot` are those of both
    joins (customer and month, customer) if known, as from stored counts, else they are counted first. A customer that occurs
    twice in a customer table repeats its loans; check with `assert_unique` first where that must not happen.

    The state of the label month (missed installments, overdue amount, both flags) is part of the features.
    Name it in `exclude` to keep it away from a model that predicts this month's label.
    """
    base = at_month_on_book(loans, mob).transform(risk_flags).drop(*LOAN_COLUMNS_DROPPED)
    attributes = attributes.drop(SNAPSHOT)
    financials = financials.drop(*FINANCIAL_COLUMNS_DROPPED)
    customer, monthly, by = [CUSTOMER], [CUSTOMER, SNAPSHOT], ["loan_id", SNAPSHOT]
    hot_months, hot_customers = hot or find_hot_keys(
        (monthly, {"loans": base, "clicks": clicks}),
        (customer, {"loans": base, "attributes": attributes, "financials": financials}),
        rows_per_task=rows_per_task,
    )
    needed = clicks if months is None else clicks.where(F.col(SNAPSHOT).isin(list(months)))
    with_clicks = spread(base, "loans", hot_months, by).transform(attach, needed, "clicks", monthly, hot_months)
    joined = (
        spread(with_clicks.drop(SALT, OWNER), "loans", hot_customers, by)
        .transform(attach, attributes, "attributes", customer, hot_customers)
        .transform(attach, financials, "financials", customer, hot_customers)
    )
    order = [
        *base.columns,
        *[c for side in (attributes, financials, clicks) for c in side.columns if c not in monthly],
    ]
    return joined.select(order).drop(*exclude)


def customer_matrix(
    loans: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    clicks: DataFrame,
    features: Sequence[str] = CLICK_FEATURES,
    rows_per_task: int = ROWS_PER_TASK,
    hot: Sequence[HotKeys | None] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Click profile of every customer with one row per loan, holding loan, attribute and financial features.

    Customers without loans keep one row with NULL loan, attribute and financial columns. The loans are the
    long side and keep one partitioning through all three joins. `hot` are the hot keys of the customer join, of the loans and of
    the clicks if known, as from stored counts, else they are counted first. Without hot keys, `buckets` is in how many buckets by customer
    all tables lie: clicks are then aggregated where they are, and loans go to so many tasks by loan and by customer, so the memory of a task
    is that of a bucket, whatever the session's number of shuffle partitions.
    """
    customer = [CUSTOMER]
    attributes = attributes.drop(SNAPSHOT)
    financials = financials.drop(*FINANCIAL_COLUMNS_DROPPED)
    hot, hot_loans, hot_clicks = hot or find_hot_keys(
        (customer, {"loans": loans, "attributes": attributes, "financials": financials}),
        (["loan_id"], {"rows": loans}),
        (customer, {"rows": clicks}),
        rows_per_task=rows_per_task,
    )
    per_loan = (
        spread(loan_features(loans, hot=hot_loans, tasks=buckets), "loans", hot, by=["loan_id"])
        .transform(attach, attributes, "attributes", customer, hot)
        .transform(attach, financials, "financials", customer, hot)
        .drop(OWNER)
    )
    profile = activity_profile(clicks, features, hot=hot_clicks, placed=buckets is not None)
    if hot is None:
        return per_loan.join(profile, customer, "right")
    # A hot customer's profile is repeated per salt. Copies that meet no loan are dropped where the customer
    # has loans, and kept once where it has none.
    hot_customers = hot.small(hot.table.select(F.col(CODE).alias(CUSTOMER)))
    lending = latest_owner(loans).join(hot_customers, customer, "left_semi").select(CUSTOMER).distinct()
    copies = (
        spread(profile, "profile", hot)
        .drop(OWNER)
        .join(hot.small(lending.withColumn("__has_loans", F.lit(True))), customer, "left")
    )
    joined = per_loan.withColumn("__loan", F.lit(True)).join(copies, [CUSTOMER, SALT], "right")
    kept = F.col("__loan").isNotNull() | (F.col("__has_loans").isNull() & (F.col(SALT) == 0))
    return joined.where(kept).drop(SALT, "__loan", "__has_loans")
