"""Builds bronze, silver and gold for a range of months, each layer in one job per table.

Every layer is a dataset partitioned by `snapshot_date`. Running a range again replaces exactly its months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.casts import text_to_date
from creditloom.functions.dates import is_month_start
from creditloom.operators.duplicates import assert_unique
from creditloom.operators.encoding import MAX_VOCABULARY
from creditloom.operators.key_counts import COUNT_FLOOR, StoredCounts, stored_hot_keys, write_key_counts
from creditloom.operators.labels import DEFAULT_DPD, DEFAULT_MOB
from creditloom.operators.skew import ROWS_PER_TASK, HotKeys
from creditloom.plans.gold import customer_matrix, feature_store, label_store
from creditloom.operators.vocabulary import extend_vocabularies, read_encoded, stored_vocabularies
from creditloom.plans.silver import learn_vocabularies, silver_attributes, silver_clicks, silver_financials, silver_loans
from creditloom.session import side_by_side
from creditloom.sources.buckets import bucket_schema, read_buckets, write_buckets
from creditloom.sources.readers import (
    between_snapshots,
    children,
    csv_header,
    first_file,
    literal,
    read_raw,
    read_snapshots,
    stored_months,
    text_schema,
    within,
)
from creditloom.sources.schemas import CUSTOMER, MONTHLY_TABLES, SNAPSHOT, STATIC_TABLES
from creditloom.sources.writers import KEPT, OUTCOME, WriteAudit, outcome_path, write_outcomes, write_snapshots, write_table


DATE_TEXT = "snapshot_text"


@dataclass(frozen=True)
class Mart:
    """Where the layers live, which months to build, and the label definition."""

    source: str
    root: str
    start: str | dt.date
    end: str | dt.date
    dpd: int = DEFAULT_DPD
    mob: int = DEFAULT_MOB
    money: str = "float"
    loan_items: Sequence[str] | None = None  # vocabularies; what is stored with what the data of the run add, unless given
    behaviours: Sequence[str] | None = None
    vocabulary: str | None = None  # where vocabularies are stored; below the root unless given
    junk_as: str | None = "0"  # what the junk payment behaviour becomes
    exclude: Sequence[str] = ()  # columns kept out of the feature store
    unique_customers: bool = False  # fail when a customer table repeats a customer
    max_vocabulary: int = MAX_VOCABULARY  # values of a vocabulary that may be learned; more are an error
    buckets: int | None = None  # silver tables in so many buckets by customer, as many as make good files
    rows_per_task: int = ROWS_PER_TASK  # a key with more rows than this is spread over tasks
    count_floor: int = COUNT_FLOOR  # rows of a key in a month above which its count is stored

    def raw(self, table: str) -> str:
        return f"{self.source}/{table}.csv"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def months(self) -> dict:
        return {"start": self.start, "end": self.end}


LEAST_BUCKETS = 8


def bucket_count(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Buckets for tables with so many rows in all, so that a bucket, which is one task's when it is written, sorted and joined, stays as
    large as it is while the tables grow."""
    return max(LEAST_BUCKETS, -(-rows // rows_per_task))


def bronze_snapshots(raw: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows of the month-start snapshots in the range, every column but the date as read."""
    dated = raw.withColumn(SNAPSHOT, text_to_date(F.col(SNAPSHOT)))
    return between_snapshots(dated, start, end).where(is_month_start(F.col(SNAPSHOT)))


def bronze_outcomes(raw: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The same rows as `kept`, and those that belong to no month with the reason why: `no_date`, `unreadable_date`, or `within_month`.

    A date within a month puts the row beside its month; the others have none. `DATE_TEXT` is the date of a rejected row as read. Rows of
    other months than those of the range are left out.
    """
    text, day = F.col(SNAPSHOT), text_to_date(F.col(SNAPSHOT))
    outcome = (
        F.when(text.isNull(), "no_date").when(day.isNull(), "unreadable_date").when(is_month_start(day), KEPT).otherwise("within_month")
    )
    parted = raw.withColumns({OUTCOME: outcome, DATE_TEXT: text, SNAPSHOT: F.trunc(day, "MM")})
    parted = parted.withColumn(DATE_TEXT, F.when(F.col(OUTCOME) != KEPT, F.col(DATE_TEXT)))
    inside = F.col(SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return parted.where(F.col(SNAPSHOT).isNull() | inside)


def build_bronze(spark: SparkSession, mart: Mart) -> dict[str, WriteAudit]:
    """Copy the customer tables whole and the monthly tables by snapshot, rejected rows aside; each source is scanned once."""

    def copied(table: str) -> WriteAudit:
        raw, path = read_raw(spark, mart.raw(table)), mart.path("bronze", table)
        if table in STATIC_TABLES:
            return write_table(raw, path, "csv")
        return write_outcomes(bronze_outcomes(raw, **mart.months), path, fmt="csv", **mart.months)

    return side_by_side(spark, {f"bronze/{table}": partial(copied, table) for table in [*STATIC_TABLES, *MONTHLY_TABLES]})


def bronze_table(spark: SparkSession, mart: Mart, table: str) -> DataFrame:
    """A monthly bronze table, limited to the mart's months by partition."""
    return read_snapshots(spark, outcome_path(mart.path("bronze", table)), fmt="csv", **mart.months).drop(DATE_TEXT)


def rejected_rows(spark: SparkSession, mart: Mart, table: str) -> DataFrame:
    """Rows of a monthly table that its last runs rejected, as read, with `outcome` as the reason, all their columns text."""
    root = mart.path("bronze", table)
    names = [x.getPath().getName() for x in children(spark, root)]
    found = [name.partition("=")[2] for name in names if name != f"{OUTCOME}={KEPT}" and first_file(spark, f"{root}/{name}")]
    parts = []
    for name in sorted(found):
        path = outcome_path(root, name)
        schema = text_schema([*csv_header(spark, first_file(spark, path)), SNAPSHOT])
        rows = spark.read.option("header", True).schema(schema).csv(literal(path))
        parts.append(rows.withColumn(OUTCOME, F.lit(name)))
    if not parts:
        return bronze_table(spark, mart, table).where(F.lit(False)).withColumns({DATE_TEXT: F.lit(""), OUTCOME: F.lit("")})
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def build_silver(spark: SparkSession, mart: Mart) -> dict[str, WriteAudit]:
    """Type and clean. The monthly tables are row by row from month to month, so they need no shuffle.

    Loans are ordered by month on book, the column that gold filters on.
    """
    attributes = silver_attributes(read_raw(spark, mart.path("bronze", "features_attributes")))
    raw_financials = read_raw(spark, mart.path("bronze", "features_financials"))
    items, behaviours = vocabularies(spark, mart, raw_financials)
    financials = silver_financials(raw_financials, items, behaviours, mart.junk_as, mart.max_vocabulary)
    clicks = silver_clicks(bronze_table(spark, mart, "feature_clickstream"))
    loans = silver_loans(bronze_table(spark, mart, "lms_loan_daily"), mart.money)
    tables = {
        "features_attributes": (attributes, [CUSTOMER]),
        "features_financials": (financials, [CUSTOMER]),
        "feature_clickstream": (clicks, [CUSTOMER]),
        "lms_loan_daily": (loans, ["mob", CUSTOMER]),
    }
    parts = {f"silver/{name}": partial(write_silver_table, mart, name, df, order) for name, (df, order) in tables.items()}
    if mart.buckets:  # their writes set the session's overwrite mode, so they run one after the other
        return {name: part() for name, part in parts.items()}
    return side_by_side(spark, parts)


def vocabularies(spark: SparkSession, mart: Mart, raw_financials: DataFrame) -> tuple[Sequence[str], Sequence[str]]:
    """Loan items and behaviours: those given, else those stored by earlier runs and then those new in this run's data."""
    if mart.loan_items is not None and mart.behaviours is not None:
        return mart.loan_items, mart.behaviours
    items, behaviours = learn_vocabularies(raw_financials, mart.junk_as, mart.max_vocabulary)
    found = {} if mart.loan_items is not None else {"loan_items": items}
    found |= {} if mart.behaviours is not None else {"behaviours": behaviours}
    known = extend_vocabularies(spark, vocabulary_root(mart), found, mart.max_vocabulary)
    given = {"loan_items": mart.loan_items, "behaviours": mart.behaviours}
    return tuple(known[name] if values is None else values for name, values in given.items())


def vocabulary_root(mart: Mart) -> str:
    return mart.vocabulary or mart.path("vocabulary", "encoded")


def feature_months(spark: SparkSession, mart: Mart) -> DataFrame:
    """The stored feature store of the mart's months with the columns of the whole vocabulary."""
    known = stored_vocabularies(spark, vocabulary_root(mart))
    items, behaviours = (given if given is not None else known.get(name, []) for name, given in (("loan_items", mart.loan_items), ("behaviours", mart.behaviours)))
    return read_encoded(spark, mart.path("gold", "feature_store"), items, behaviours, **mart.months)


#: Keys on which gold joins or aggregates each silver table.
KEYS = {table: {"customer": CUSTOMER} for table in [*STATIC_TABLES, *MONTHLY_TABLES]}
KEYS["lms_loan_daily"] = {"customer": CUSTOMER, "loan": "loan_id"}


def write_silver_table(mart: Mart, name: str, df: DataFrame, order: Sequence[str]) -> WriteAudit:
    """One silver table, and the counts of its frequent keys from what was stored."""
    spark, path, monthly = df.sparkSession, mart.path("silver", name), name in MONTHLY_TABLES
    months = mart.months if monthly else {}
    if mart.buckets:
        audit = write_buckets(df, path, mart.buckets, sort_by=order, monthly=monthly, **months)
    elif monthly:
        audit = write_snapshots(df, path, rebalance=False, sort_by=order, **months)
    else:
        audit = write_table(df, path)
    write_key_counts(silver_table(spark, mart, name), mart.path("counts", name), KEYS[name], mart.count_floor, monthly=monthly, **months)
    return audit


def silver_table(spark: SparkSession, mart: Mart, name: str, bucketed: bool = False) -> DataFrame:
    """A silver table, a monthly one limited to the mart's months. `bucketed` lets joins on the customer use its buckets."""
    path, months = mart.path("silver", name), mart.months if name in MONTHLY_TABLES else {}
    if bucketed:
        return read_buckets(spark, path, **months)
    schema = bucket_schema(spark, path) if mart.buckets else None
    if name in MONTHLY_TABLES:
        return read_snapshots(spark, path, schema=schema, **months)
    return (spark.read.schema(schema) if schema else spark.read).parquet(literal(path))


def silver_tables(spark: SparkSession, mart: Mart, bucketed: bool = False) -> dict[str, DataFrame]:
    return {table: silver_table(spark, mart, table, bucketed) for table in [*STATIC_TABLES, *MONTHLY_TABLES]}


def _counts(spark: SparkSession, mart: Mart, table: str) -> StoredCounts:
    if table in STATIC_TABLES:
        return StoredCounts(mart.path("counts", table), floor=mart.count_floor)
    held = sum(within(month, mart.start, mart.end) for month in stored_months(spark, mart.path("silver", table)))
    return StoredCounts(mart.path("counts", table), held, mart.count_floor, mart.start, mart.end)


def feature_hot_keys(spark: SparkSession, mart: Mart) -> list[HotKeys | None] | None:
    """Hot keys of the two joins of the feature store, from the counts stored with silver.

    Loans are counted over all their months on book, so a key may be spread that is not quite hot at the label's month.
    """
    loans, clicks = (_counts(spark, mart, table) for table in ("lms_loan_daily", "feature_clickstream"))
    static = {name: (_counts(spark, mart, f"features_{name}"), "customer") for name in ("attributes", "financials")}
    joins = [
        ([CUSTOMER, SNAPSHOT], {"loans": (loans, "customer"), "clicks": (clicks, "customer")}),
        ([CUSTOMER], {"loans": (loans, "customer"), **static}),
    ]
    return stored_hot_keys(spark, joins, mart.rows_per_task)


def matrix_hot_keys(spark: SparkSession, mart: Mart) -> list[HotKeys | None] | None:
    """Hot keys of the customer matrix: of its join, of the loans and of the clicks."""
    loans, clicks = (_counts(spark, mart, table) for table in ("lms_loan_daily", "feature_clickstream"))
    static = {name: (_counts(spark, mart, f"features_{name}"), "customer") for name in ("attributes", "financials")}
    joins = [
        ([CUSTOMER], {"loans": (loans, "customer"), **static}),
        (["loan_id"], {"rows": (loans, "loan")}),
        ([CUSTOMER], {"rows": (clicks, "customer")}),
    ]
    return stored_hot_keys(spark, joins, mart.rows_per_task)


def stored_features(spark: SparkSession, mart: Mart, months: Sequence[dt.date] | None = None) -> DataFrame:
    """The feature store over stored silver: hot keys from the stored counts, and joins in buckets where no key is hot."""
    hot = feature_hot_keys(spark, mart)
    silver = silver_tables(spark, mart, bucketed=mart.buckets is not None and hot is not None and not any(hot))
    return feature_store(
        silver["lms_loan_daily"],
        silver["features_attributes"],
        silver["features_financials"],
        silver["feature_clickstream"],
        mart.mob,
        mart.exclude,
        mart.rows_per_task,
        months,
        hot,
    )


def stored_matrix(spark: SparkSession, mart: Mart) -> DataFrame:
    """The customer matrix over stored silver, by the same means."""
    hot = matrix_hot_keys(spark, mart)
    bucketed = mart.buckets is not None and hot is not None and not any(hot)
    silver = silver_tables(spark, mart, bucketed)
    return customer_matrix(
        silver["lms_loan_daily"],
        silver["features_attributes"],
        silver["features_financials"],
        silver["feature_clickstream"],
        rows_per_task=mart.rows_per_task,
        hot=hot,
        buckets=mart.buckets if bucketed else None,
    )


def build_gold(spark: SparkSession, mart: Mart) -> dict[str, WriteAudit]:
    if mart.unique_customers:
        for table in STATIC_TABLES:
            assert_unique(silver_table(spark, mart, table), CUSTOMER)
    loans = silver_table(spark, mart, "lms_loan_daily")
    labels = write_snapshots(label_store(loans, mart.dpd, mart.mob), mart.path("gold", "label_store"), **mart.months)
    features = stored_features(spark, mart, months=labels.snapshots)
    stored = write_snapshots(features, mart.path("gold", "feature_store"), **mart.months)
    return {"gold/label_store": labels, "gold/feature_store": stored}


def backfill(spark: SparkSession, mart: Mart) -> dict[str, WriteAudit]:
    """Build all layers for the mart's months; returns rows and months written per table."""
    return build_bronze(spark, mart) | build_silver(spark, mart) | build_gold(spark, mart)
