"""Cleaning and encoding of customer attributes and financials."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.casts import retype
from creditloom.operators.cleaning import (
    MISSING_CREDIT_MIX,
    MISSING_LOAN_TYPE,
    duration_months,
    keep_age_range,
    mask_pattern,
    null_sentinels,
    numeric_text,
    payment_behaviour,
    trim_text,
    yes_flag,
)
from creditloom.operators.duplicates import shared_count, top_values, value_counts
from creditloom.operators.encoding import (
    credit_mix_flags,
    learn_items,
    learn_levels,
    list_items,
    multi_hot,
    one_hot,
)
from creditloom.plans.silver import silver_attributes, silver_financials
from creditloom.queries.inputs import attributes, financials
from creditloom.queries.oracle import (
    ATTRIBUTES,
    BEHAVIOUR,
    BEHAVIOUR_FLAGS,
    CLEAN_ATTRIBUTES,
    COUNTS,
    FINANCIALS,
    GOLD_FINANCIAL_COLUMNS,
    HISTORY,
    INCOME,
    ITEM_FLAGS,
    MEASURES,
    MIN_PAYMENT,
    MIX_FLAGS,
    MIX_VALID,
)
from creditloom.queries.shape import widened
from creditloom.sources.schemas import financial_types


def q06_attr_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_attributes(attributes(spark, sf_dir))


def q07_ssn_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pattern(attributes(spark, sf_dir)).select("customer_id", "ssn", "ssn_valid")


def q08_age_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_age_range(attributes(spark, sf_dir)).select("customer_id", "age", "age_int")


def q09_shared_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = trim_text(attributes(spark, sf_dir), "name").select("customer_id", "name")
    return shared_count(trimmed)


def q10_freq_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(trim_text(attributes(spark, sf_dir), "name"), "name", 20)


def q11_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(numeric_text(financials(spark, sf_dir)).select("customer_id", "annual_income"))


def q12_credit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duration_months(financials(spark, sf_dir)).select("customer_id", "credit_history_age", *HISTORY)


def q13_min_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yes_flag(financials(spark, sf_dir)).select("customer_id", "payment_of_min_amount")


def q14_retype_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = financial_types()
    return widened(retype(financials(spark, sf_dir).select("customer_id", *types), types))


def q15_multi_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan types as columns, with the vocabulary learned from the table."""
    raw = financials(spark, sf_dir).select("customer_id", "type_of_loan")
    return multi_hot(raw, "type_of_loan", learn_items(raw))


def q16_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_items(financials(spark, sf_dir), "type_of_loan").orderBy("item")


def q17_credit_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = financials(spark, sf_dir).select("customer_id", "credit_mix")
    return raw.transform(null_sentinels, "credit_mix", MISSING_CREDIT_MIX).transform(credit_mix_flags)


def q18_pb_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment behaviour as columns, with the levels learned from the table."""
    cleaned = payment_behaviour(financials(spark, sf_dir).select("customer_id", "payment_behaviour"))
    return one_hot(cleaned, "payment_behaviour", learn_levels(cleaned), "pb_")


def q19_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentinels of three columns as NULL, with junk payment behaviour void instead of '0'."""
    raw = financials(spark, sf_dir).select("customer_id", "credit_mix", "type_of_loan", "payment_behaviour")
    return (
        raw.transform(null_sentinels, "credit_mix", MISSING_CREDIT_MIX)
        .transform(null_sentinels, "type_of_loan", MISSING_LOAN_TYPE)
        .transform(payment_behaviour, junk_as=None)
    )


def q44_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(attributes(spark, sf_dir), "ssn")


def q45_silver_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(silver_financials(financials(spark, sf_dir)))


def q46_multi_hot_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-item matching with the vocabulary that also holds items seen only after "and"."""
    raw = financials(spark, sf_dir).select("customer_id", "type_of_loan")
    return multi_hot(raw, "type_of_loan", learn_items(raw, strip_conjunction=True), exact=True)


def q47_item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per loan type, as one row."""
    raw = financials(spark, sf_dir).select("type_of_loan")
    encoded = multi_hot(raw, "type_of_loan", learn_items(raw)).drop("type_of_loan")
    return encoded.agg(*[F.sum(c).alias(c) for c in encoded.columns])


QUERIES = {
    f.__name__: f
    for f in (
        q06_attr_clean,
        q07_ssn_mask,
        q08_age_range,
        q09_shared_names,
        q10_freq_topk,
        q11_income,
        q12_credit_history,
        q13_min_payment,
        q14_retype_financials,
        q15_multi_hot,
        q16_vocab,
        q17_credit_mix,
        q18_pb_one_hot,
        q19_sentinels,
        q44_value_counts,
        q45_silver_financials,
        q46_multi_hot_exact,
        q47_item_totals,
    )
}

ALL_ITEMS = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Not Specified",
    "Payday Loan",
    "Student Loan",
]


def _name(item: str) -> str:
    return item.replace(" ", "_").replace("-", "_").lower()


EXACT_FLAGS = [
    f"CASE WHEN list_contains(parts, '{i}') THEN 1 ELSE 0 END AS {_name(i)}" for i in ALL_ITEMS
]
ITEM_SUMS = [
    f"CAST(sum(CASE WHEN contains(type_of_loan, '{i}') THEN 1 ELSE 0 END) AS BIGINT) AS {_name(i)}"
    for i in ALL_ITEMS
    if i != "Mortgage Loan"
]
MIX = "CASE WHEN credit_mix <> '_' THEN credit_mix END AS credit_mix"

ORACLE = {
    "q06_attr_clean": f"WITH {CLEAN_ATTRIBUTES}\nSELECT * FROM attributes",
    "q07_ssn_mask": f"""WITH {ATTRIBUTES}
SELECT customer_id, CASE WHEN ok THEN ssn END AS ssn, CASE WHEN ok THEN 1 ELSE 0 END AS ssn_valid
FROM (SELECT *, regexp_matches(ssn, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AS ok FROM raw_attributes)""",
    "q08_age_range": f"""WITH {ATTRIBUTES}
SELECT customer_id, age, TRY_CAST(age AS INT) AS age_int FROM raw_attributes
WHERE TRY_CAST(age AS INT) BETWEEN 15 AND 100""",
    "q09_shared_names": f"""WITH {ATTRIBUTES}, named AS (SELECT customer_id, trim(name) AS name FROM raw_attributes)
SELECT n.customer_id, n.name, c.n AS name_shared_count, CASE WHEN c.n > 1 THEN 1 ELSE 0 END AS is_name_shared
FROM named n LEFT JOIN (SELECT name, count(*) AS n FROM named GROUP BY name) c ON n.name = c.name""",
    "q10_freq_topk": f"""WITH {ATTRIBUTES}
SELECT trim(name) AS name, count(*) AS count FROM raw_attributes GROUP BY trim(name)
ORDER BY count(*) DESC, trim(name) ASC NULLS FIRST LIMIT 20""",
    "q11_income": f"WITH {FINANCIALS}\nSELECT customer_id, {INCOME} FROM raw_financials",
    "q12_credit_history": f"""WITH {FINANCIALS}
SELECT customer_id, credit_history_age, {", ".join(f"{e} AS {n}" for n, e in HISTORY.items())} FROM raw_financials""",
    "q13_min_payment": f"WITH {FINANCIALS}\nSELECT customer_id, {MIN_PAYMENT} FROM raw_financials",
    "q14_retype_financials": f"WITH {FINANCIALS}\nSELECT customer_id, {', '.join(MEASURES + COUNTS)} FROM raw_financials",
    "q15_multi_hot": f"WITH {FINANCIALS}\nSELECT customer_id, type_of_loan, {', '.join(ITEM_FLAGS)} FROM raw_financials",
    "q16_vocab": f"""WITH {FINANCIALS}
SELECT DISTINCT trim(part) AS item
FROM (SELECT unnest(string_split_regex(type_of_loan, ',\\s*')) AS part FROM raw_financials)
WHERE NOT regexp_matches(trim(part), '(?i)^and\\b.*') ORDER BY item""",
    "q17_credit_mix": f"""WITH {FINANCIALS}
SELECT customer_id, {MIX}, {", ".join(MIX_FLAGS)}, {MIX_VALID} FROM raw_financials""",
    "q18_pb_one_hot": f"""WITH {FINANCIALS}
SELECT customer_id, {BEHAVIOUR} AS payment_behaviour,
  CAST(payment_behaviour IS NOT NULL AS INT) AS has_valid_payment_behavior, {", ".join(BEHAVIOUR_FLAGS)}
FROM raw_financials""",
    "q19_sentinels": f"""WITH {FINANCIALS}, cleaned AS (
  SELECT customer_id, {MIX},
    CASE WHEN type_of_loan NOT IN ('NULL', 'Not Specified') THEN type_of_loan END AS type_of_loan,
    nullif(lower(payment_behaviour), '!@9#%8') AS payment_behaviour FROM raw_financials)
SELECT *, CAST(payment_behaviour IS NOT NULL AS INT) AS has_valid_payment_behavior FROM cleaned""",
    "q44_value_counts": f"WITH {ATTRIBUTES}\nSELECT ssn, count(*) AS count FROM raw_attributes GROUP BY ssn ORDER BY 2 DESC",
    "q45_silver_financials": f"""WITH {FINANCIALS}
SELECT customer_id, {HISTORY['credit_history_years']} AS credit_history_years,
  {HISTORY['credit_history_months']} AS credit_history_months, {MIX}, {BEHAVIOUR} AS payment_behaviour,
  {GOLD_FINANCIAL_COLUMNS} FROM raw_financials""",
    "q46_multi_hot_exact": f"""WITH {FINANCIALS}
SELECT customer_id, type_of_loan, {", ".join(EXACT_FLAGS)}
FROM (SELECT *, list_transform(string_split_regex(type_of_loan, ',\\s*'),
    lambda p: regexp_replace(trim(p), '(?i)^and\\b\\s*', '')) AS parts FROM raw_financials)""",
    "q47_item_totals": f"WITH {FINANCIALS}\nSELECT {', '.join(ITEM_SUMS)} FROM raw_financials",
}
