"""SQL over named relations, the calendar, and tables written and read back."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.dates import months_spanned, snapshot_label
from creditloom.operators.profiling import catalog_counts, row_audit, row_count
from creditloom.functions.casts import text_to_date
from creditloom.operators.encoding import learn_items, multi_hot
from creditloom.operators.vocabulary import extend_vocabularies, read_encoded, stored_vocabularies
from creditloom.plans.backfill import Mart, backfill, bronze_outcomes, bronze_snapshots, bronze_table, rejected_rows
from creditloom.plans.gold import label_store
from creditloom.plans.publish import publish, published
from creditloom.plans.silver import silver_loans
from creditloom.queries.inputs import attributes, clicks, financials, loan_panel, raw_clicks, raw_loans, table
from creditloom.queries.loans import panel
from creditloom.queries.oracle import (
    ATTRIBUTES,
    CLEAN_ATTRIBUTES,
    CLEAN_FINANCIALS,
    CLICKS,
    DIRTY,
    DIRTY_CLICKS,
    FINANCIALS,
    ITEM_FLAGS,
    LOANS,
    PANEL,
    RAW_AMOUNTS,
)
from creditloom.queries.shape import widened
from creditloom.session import scratch_folder, shared_folder, side_by_side
from creditloom.sources.readers import at_snapshot, load_catalog, lookup, read_raw, read_snapshots, register
from creditloom.sources.writers import write_outcomes, write_snapshots, write_table

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]
SCAN_FROM, SCAN_TO = "1997-01-01", "1998-12-01"


def _range(rows: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last snapshot of a table."""
    return tuple(rows.agg(F.min("snapshot_date"), F.max("snapshot_date")).first())


def q33_sql_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality lookup in SQL, sorted by two columns."""
    register({"attributes": attributes(spark, sf_dir)})
    return spark.sql("SELECT * FROM attributes WHERE name = '  Name42 ' ORDER BY name, customer_id")


def q34_sql_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    register({"clickstream": clicks(spark, sf_dir)})
    return spark.sql(
        """
        SELECT customer_id, snapshot_date, COUNT(snapshot_date) AS entries
        FROM clickstream
        GROUP BY customer_id, snapshot_date
        ORDER BY customer_id, snapshot_date
        """
    )


def q35_sql_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    register({"loan_panel": loan_panel(spark, sf_dir)})
    return spark.sql("SELECT COUNT(*) AS row_count FROM loan_panel")


def q36_sql_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    register({"financials": financials(spark, sf_dir)})
    return spark.sql("SELECT * FROM financials ORDER BY customer_id LIMIT 1")


def q37_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month the panel spans, with its file label and its number of rows, empty months included."""
    rows = panel(spark, sf_dir)
    counted = row_audit(rows)
    return (
        months_spanned(rows, "snapshot_date")
        .join(counted, "snapshot_date", "left")
        .select(
            "snapshot_date",
            snapshot_label(F.col("snapshot_date")).alias("label"),
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )


def q38_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text panel to one CSV source, to monthly CSV snapshots, and back to a typed silver table."""
    folder = scratch_folder(spark, "q38", sf_dir)
    write_table(raw_loans(spark, sf_dir), f"{folder}/source", "csv")
    source = read_raw(spark, f"{folder}/source")
    months = _range(loan_panel(spark, sf_dir))
    write_snapshots(bronze_snapshots(source, *months), f"{folder}/bronze", *months, "csv")
    return widened(silver_loans(read_snapshots(spark, f"{folder}/bronze", *months, "csv")))


def q39_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of months from a partitioned panel."""
    folder = scratch_folder(spark, "q39", sf_dir)
    write_snapshots(loan_panel(spark, sf_dir), folder)
    return read_snapshots(spark, folder, SCAN_FROM, SCAN_TO).select("loan_id", "snapshot_date", "due_amt")


def q40_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_audit(panel(spark, sf_dir))


def q41_backfill_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label store of all months, then two years of it built again with another definition."""
    folder = scratch_folder(spark, "q41", sf_dir)
    loans = panel(spark, sf_dir)
    write_snapshots(label_store(loans), folder, *_range(loans))
    part = loans.where(F.col("snapshot_date").between(SCAN_FROM, SCAN_TO))
    write_snapshots(label_store(part, dpd=60), folder, SCAN_FROM, SCAN_TO)
    return read_snapshots(spark, folder)


def q42_catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that a sweep of the folder finds."""
    return catalog_counts(load_catalog(spark, sf_dir, "parquet"))


def q43_projection_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subset, alias, computed, constant and dropped columns, over distinct rows of a bag of snapshots."""
    return (
        loan_panel(spark, sf_dir)
        .select("customer_id", F.col("snapshot_date").alias("month"), "installment_num", "tenure")
        .withColumns({"remaining": F.col("tenure") - F.col("installment_num"), "source": F.lit("panel")})
        .drop("tenure", "no_such_column")
        .distinct()
    )


def q51_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of the panel by equality."""
    return at_snapshot(loan_panel(spark, sf_dir), SCAN_FROM).select("loan_id", "customer_id", "due_amt")


def q52_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with mixed-case names, read with inferred types."""
    folder = scratch_folder(spark, "q52", sf_dir)
    renamed = {"o_orderkey": "Order_Key", "o_orderdate": "OrderDate", "o_totalprice": "TOTAL", "o_orderstatus": "status"}
    orders = table(spark, sf_dir, "orders").select(*[F.col(c).alias(n) for c, n in renamed.items()])
    write_table(orders.withColumn("OrderDate", F.col("OrderDate").cast("date")), folder, "csv")
    return read_raw(spark, folder, infer=True)


def q53_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from text in two layouts, with text that is no date."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    iso = F.when(key % 7 == 0, "unknown").otherwise(day.cast("string"))
    local = F.when(key % 11 == 0, "31/02/2000").otherwise(F.date_format(day, "dd/MM/yyyy"))
    orders = table(spark, sf_dir, "orders").select(key.alias("loan_id"), iso.alias("iso"), local.alias("local"))
    return orders.select(
        "loan_id", text_to_date(F.col("iso")).alias("iso"), text_to_date(F.col("local"), "dd/MM/yyyy").alias("local")
    )


def q54_faithful_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks in keys and flags through a static and a monthly CSV, whose second run has its columns in another order."""
    folder = scratch_folder(spark, "q54", sf_dir)
    dirty = attributes(spark, sf_dir).select(
        F.concat(F.col("customer_id"), F.when(F.col("customer_id").cast("bigint") % 3 == 0, "  ").otherwise("")).alias("customer_id"),
        "name",
        F.when(F.col("customer_id").cast("bigint") % 5 == 0, "   ").otherwise(F.col("occupation")).alias("occupation"),
    )
    write_table(dirty, f"{folder}/static", "csv")
    static = read_raw(spark, f"{folder}/static")
    early, late = F.lit("2023-01-01").cast("date"), F.lit("2023-02-01").cast("date")
    months = static.withColumn("snapshot_date", F.when(F.length("customer_id") % 2 == 0, early).otherwise(late))
    monthly = f"{folder}/monthly"
    write_snapshots(months.where(F.col("snapshot_date") == early), monthly, "2023-01-01", "2023-01-01", "csv")
    other_order = months.select("occupation", "name", "customer_id", "snapshot_date").where(F.col("snapshot_date") == late)
    write_snapshots(other_order, monthly, "2023-02-01", "2023-02-01", "csv")
    return read_snapshots(spark, monthly, fmt="csv").select("customer_id", "name", "occupation", "snapshot_date")


def q55_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mart from CSV sources with mixed-case names: labels with some of the features of the same month."""
    folder = scratch_folder(spark, "q55", sf_dir)
    first, last = _write_sources(spark, sf_dir, f"{folder}/source")
    mart = Mart(f"{folder}/source", f"{folder}/mart", first, last)
    backfill(spark, mart)
    labels, features = (spark.read.parquet(mart.path("gold", t)) for t in ("label_store", "feature_store"))
    chosen = features.select("loan_id", "snapshot_date", "installments_missed", "has_overdue_amt", "name_shared_count", "auto_loan", "fe_2")
    return labels.join(chosen, ["loan_id", "snapshot_date"], "left")


def q57_month_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV months written by three runs: one has a column more than the others, one a column less and another order."""
    folder = scratch_folder(spark, "q57", sf_dir)
    rows = raw_loans(spark, sf_dir).select("loan_id", "due_amt", "balance", F.col("snapshot_date").cast("date").alias("snapshot_date"))
    day = F.col("snapshot_date")
    first, last = _range(rows)
    runs = [
        (first, "1996-12-01", rows),
        ("1997-01-01", "1997-12-01", rows.withColumn("channel", F.concat(F.lit(" c"), F.col("loan_id")))),
        ("1998-01-01", last, rows.select("balance", "loan_id", "snapshot_date")),
    ]
    for start, end, months in runs:
        write_snapshots(months.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))), folder, start, end, "csv")
    return read_snapshots(spark, folder, fmt="csv").select("loan_id", "due_amt", "balance", "channel", "snapshot_date")


def q62_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze clicks with missing, unreadable and mid-month dates: kept and rejected rows by reason and month."""
    folder = scratch_folder(spark, "q62", sf_dir)
    key, text = F.col("customer_id").cast("bigint"), F.col("snapshot_date")
    dates = F.when(key % 43 == 0, F.lit(None)).when(key % 47 == 0, F.concat(F.substring(text, 1, 8), F.lit("15"))).otherwise(text)
    source = raw_clicks(spark, sf_dir).withColumn("snapshot_date", dates)
    write_table(source, f"{folder}/source/feature_clickstream.csv", "csv")
    first, last = _range(clicks(spark, sf_dir))
    mart = Mart(f"{folder}/source", f"{folder}/mart", first, last)
    parted = bronze_outcomes(read_raw(spark, mart.raw("feature_clickstream")), **mart.months)
    write_outcomes(parted, mart.path("bronze", "feature_clickstream"), fmt="csv", **mart.months)
    kept = bronze_table(spark, mart, "feature_clickstream").withColumns({"outcome": F.lit("kept"), "snapshot_text": F.lit(None).cast("string")})
    both = kept.unionByName(rejected_rows(spark, mart, "feature_clickstream"))
    return both.groupBy("outcome", "snapshot_date", "snapshot_text").agg(F.count("fe_2").alias("known"), F.count(F.lit(1)).alias("row_count"))


def q63_vocabulary_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan types of two runs: the second brings new ones, and the first one's month reads 0 for them."""
    folder = shared_folder(spark)
    raw = financials(spark, sf_dir).select("customer_id", "type_of_loan", F.lit(1).alias("has_valid_payment_behavior"))
    few = F.coalesce(F.col("type_of_loan"), F.lit("")).isin("", "Auto Loan", "Not Specified")
    for month, rows in (("2023-01-01", raw.where(few)), ("2023-02-01", raw.where(~few))):
        items = extend_vocabularies(spark, f"{folder}/vocabulary", {"loan_items": learn_items(rows)})["loan_items"]
        encoded = multi_hot(rows, "type_of_loan", items).withColumn("snapshot_date", F.lit(month).cast("date"))
        write_snapshots(encoded, f"{folder}/months", month, month)
    known = stored_vocabularies(spark, f"{folder}/vocabulary")["loan_items"]
    return read_encoded(spark, f"{folder}/months", known).drop("has_valid_payment_behavior")


def q64_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all months published by one run, and of a year of them by a second one with another definition."""
    folder = shared_folder(spark)
    first, last = _write_sources(spark, sf_dir, f"{folder}/source")
    mart = Mart(f"{folder}/source", f"{folder}/mart", first, last)
    publish(spark, mart, "first")
    publish(spark, replace(mart, start="1997-01-01", end="1997-12-01", dpd=60), "second")
    return published(spark, mart.root, "gold/label_store").select("loan_id", "customer_id", "label", "label_def", "snapshot_date")


def _write_sources(spark: SparkSession, sf_dir: str, folder: str) -> tuple[dt.date, dt.date]:
    """Write the four sources; first and last snapshot of the loans, seen while they are written."""
    seen, day = Observation(), F.col("snapshot_date").cast("date")
    sources = {
        "lms_loan_daily": raw_loans(spark, sf_dir).observe(seen, F.min(day).alias("first"), F.max(day).alias("last")),
        "feature_clickstream": raw_clicks(spark, sf_dir),
        "features_attributes": attributes(spark, sf_dir),
        "features_financials": financials(spark, sf_dir),
    }

    def written(name: str, df: DataFrame) -> None:
        write_table(df.withColumnRenamed("customer_id", "Customer_ID"), f"{folder}/{name}.csv", "csv")

    side_by_side(spark, {name: partial(written, name, df) for name, df in sources.items()})
    return seen.get["first"], seen.get["last"]


def q49_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers of one occupation."""
    found = lookup(attributes(spark, sf_dir), "occupation", " BUILDING")
    return found.select("customer_id", "name", "occupation").orderBy("customer_id")


def q50_total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(panel(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        q33_sql_lookup,
        q34_sql_group_count,
        q35_sql_count,
        q36_sql_limit,
        q37_calendar,
        q38_bronze_roundtrip,
        q39_snapshot_scan,
        q40_row_audit,
        q41_backfill_rerun,
        q42_catalog_counts,
        q43_projection_basics,
        q49_lookup,
        q50_total_rows,
        q51_snapshot,
        q52_inferred_types,
        q53_date_formats,
        q54_faithful_bronze,
        q55_backfill,
        q57_month_columns,
        q62_rejected_rows,
        q63_vocabulary_runs,
        q64_publication,
    )
}

ORACLE = {
    "q33_sql_lookup": f"WITH {ATTRIBUTES}\nSELECT * FROM raw_attributes WHERE name = '  Name42 '",
    "q34_sql_group_count": f"""WITH {CLICKS}
SELECT customer_id, snapshot_date, count(snapshot_date) AS entries
FROM clicks GROUP BY customer_id, snapshot_date""",
    "q35_sql_count": f"WITH {PANEL}\nSELECT count(*) AS row_count FROM panel",
    "q36_sql_limit": f"WITH {FINANCIALS}\nSELECT * FROM raw_financials ORDER BY customer_id LIMIT 1",
    "q37_calendar": f"""WITH {LOANS}, bounds AS (SELECT min(snapshot_date) AS lo, max(snapshot_date) AS hi FROM loans),
months AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM bounds)
SELECT m.snapshot_date, strftime(m.snapshot_date, '%Y_%m_%d') AS label, count(l.loan_id) AS row_count
FROM months m LEFT JOIN loans l ON m.snapshot_date = l.snapshot_date GROUP BY m.snapshot_date""",
    "q38_bronze_roundtrip": f"WITH {DIRTY}\nSELECT * FROM loans",
    "q39_snapshot_scan": f"""WITH {PANEL}
SELECT loan_id, snapshot_date, due_amt FROM panel
WHERE snapshot_date BETWEEN DATE '{SCAN_FROM}' AND DATE '{SCAN_TO}'""",
    "q40_row_audit": f"WITH {LOANS}\nSELECT snapshot_date, count(*) AS row_count FROM loans GROUP BY snapshot_date",
    "q41_backfill_rerun": f"""WITH {LOANS}, labelled AS (
  SELECT *, CASE WHEN snapshot_date BETWEEN DATE '{SCAN_FROM}' AND DATE '{SCAN_TO}' THEN 60 ELSE 30 END AS threshold
  FROM loans WHERE mob = 6)
SELECT loan_id, customer_id, CASE WHEN dpd >= threshold THEN 1 ELSE 0 END AS label,
  concat(CAST(threshold AS STRING), 'dpd_6mob') AS label_def, snapshot_date FROM labelled""",
    "q42_catalog_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "q43_projection_basics": f"""WITH {PANEL}
SELECT DISTINCT customer_id, snapshot_date AS month, installment_num, tenure - installment_num AS remaining,
  'panel' AS source FROM panel""",
    "q49_lookup": f"WITH {ATTRIBUTES}\nSELECT customer_id, name, occupation FROM raw_attributes WHERE occupation = ' BUILDING'",
    "q51_snapshot": f"""WITH {PANEL}
SELECT loan_id, customer_id, due_amt FROM panel WHERE snapshot_date = DATE '{SCAN_FROM}'""",
    "q52_inferred_types": """SELECT CAST(o_orderkey AS INT) AS order_key, CAST(o_orderdate AS DATE) AS orderdate,
  o_totalprice AS total, o_orderstatus AS status FROM orders""",
    "q53_date_formats": """SELECT o_orderkey AS loan_id,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS iso,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS local FROM orders""",
    "q54_faithful_bronze": f"""WITH {ATTRIBUTES}, dirty AS (
  SELECT concat(customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN '  ' ELSE '' END) AS customer_id, name,
    CASE WHEN CAST(customer_id AS BIGINT) % 5 = 0 THEN '   ' ELSE occupation END AS occupation FROM raw_attributes)
SELECT *, CASE WHEN length(customer_id) % 2 = 0 THEN DATE '2023-01-01' ELSE DATE '2023-02-01' END AS snapshot_date
FROM dirty""",
    "q55_backfill": f"""WITH {DIRTY},
{DIRTY_CLICKS},
{CLEAN_ATTRIBUTES},
{CLEAN_FINANCIALS}
SELECT l.loan_id, l.customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def,
  l.snapshot_date, installments_missed, CASE WHEN overdue_amt > 0 THEN 1 ELSE 0 END AS has_overdue_amt,
  name_shared_count, auto_loan, fe_2
FROM loans l LEFT JOIN attributes a ON l.customer_id = a.customer_id LEFT JOIN financials f ON l.customer_id = f.customer_id
LEFT JOIN raw_clicks c ON l.customer_id = c.customer_id AND l.snapshot_date = c.snapshot_date
WHERE mob = 6""",
    "q62_rejected_rows": f"""WITH {CLICKS}, dated AS (
  SELECT fe_2, CAST(customer_id AS BIGINT) AS k, CAST(customer_id AS BIGINT) % 50 <> 0 AS named, snapshot_date AS month FROM clicks),
parted AS (SELECT *, CASE WHEN named AND k % 43 = 0 THEN 'no_date' WHEN k % 41 = 0 THEN 'unreadable_date'
    WHEN named AND k % 47 = 0 THEN 'within_month' ELSE 'kept' END AS outcome FROM dated)
SELECT outcome, CASE WHEN outcome IN ('kept', 'within_month') THEN month END AS snapshot_date,
  CASE outcome WHEN 'within_month' THEN strftime(month, '%Y-%m-15') WHEN 'unreadable_date' THEN CASE WHEN named AND k % 47 = 0 THEN 'unknown' || '15' ELSE 'unknown' END END
    AS snapshot_text, count(fe_2) AS known, count(*) AS row_count
FROM parted GROUP BY 1, 2, 3""",
    "q63_vocabulary_runs": f"""WITH {FINANCIALS}
SELECT customer_id, type_of_loan, {", ".join(ITEM_FLAGS)},
  CASE WHEN coalesce(type_of_loan, '') IN ('', 'Auto Loan', 'Not Specified') THEN DATE '2023-01-01' ELSE DATE '2023-02-01' END AS snapshot_date
FROM (SELECT * FROM raw_financials)""",
    "q64_publication": f"""WITH {DIRTY}, labelled AS (
  SELECT *, CASE WHEN year(snapshot_date) = 1997 THEN 60 ELSE 30 END AS threshold FROM loans WHERE mob = 6)
SELECT loan_id, customer_id, CASE WHEN dpd >= threshold THEN 1 ELSE 0 END AS label,
  concat(CAST(threshold AS STRING), 'dpd_6mob') AS label_def, snapshot_date FROM labelled""",
    "q57_month_columns": f"""WITH {RAW_AMOUNTS}
SELECT loan_id, CASE WHEN snapshot_date < DATE '1998-01-01' THEN due_text END AS due_amt, balance_text AS balance,
  CASE WHEN year(snapshot_date) = 1997 THEN concat(' c', loan_id) END AS channel, snapshot_date FROM raw_amounts""",
    "q50_total_rows": f"WITH {LOANS}\nSELECT count(*) AS row_count FROM loans",
}
