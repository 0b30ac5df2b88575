"""SQL for the derived source tables and for the silver and gold tables on top, as CTEs for the oracle."""

from __future__ import annotations

from creditloom.sources.schemas import FINANCIAL_COUNTS, FINANCIAL_MEASURES

KINDS = ["click", "error", "purchase", "signup", "view"]
FE = [f"fe_{i}" for i in range(1, 21)]

PANEL = """panel AS (
  SELECT CAST(o_orderkey AS STRING) AS loan_id, CAST(o_custkey AS STRING) AS customer_id,
    CAST(o_orderdate AS DATE) AS loan_start_date, 7 AS tenure, l_linenumber AS installment_num,
    CAST(floor(o_totalprice) AS DOUBLE) AS loan_amt, due_amt, due_amt * 4 - overdue_amt AS paid_amt, overdue_amt,
    CAST(floor(o_totalprice) AS DOUBLE) - due_amt AS balance,
    CAST(date_trunc('month', CAST(o_orderdate AS DATE) + to_months(l_linenumber)) AS DATE) AS snapshot_date
  FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, l_linenumber, sum(l_quantity) AS due_amt,
      sum(CASE WHEN l_linestatus = 'O' THEN l_quantity * CAST(round(l_discount * 100) AS INT) ELSE 0 END) / 4.0
        AS overdue_amt
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderkey, o_custkey, o_orderdate, o_totalprice, l_linenumber))"""


def silver(source: str, name: str = "loans") -> str:
    """Delinquency columns on a typed panel that may hold NULL amounts."""
    return f"""missed_{name} AS (
  SELECT loan_id, customer_id, loan_start_date, coalesce(tenure, 0) AS tenure,
    coalesce(installment_num, 0) AS installment_num, coalesce(loan_amt, 0) AS loan_amt,
    coalesce(due_amt, 0) AS due_amt, coalesce(paid_amt, 0) AS paid_amt, coalesce(overdue_amt, 0) AS overdue_amt,
    coalesce(balance, 0) AS balance, snapshot_date, coalesce(installment_num, 0) AS mob,
    coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS INT), 0) AS installments_missed
  FROM {source}),
dated_{name} AS (SELECT *, CASE WHEN installments_missed > 0
    THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM missed_{name}),
{name} AS (SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END
    AS INT) AS dpd FROM dated_{name})"""


LOANS = f"{PANEL},\n{silver('panel')}"

# The text panel after typing: the same rows with the amounts that survive it.
DIRTY = f"""{PANEL},
typed AS (SELECT * REPLACE (
    CASE WHEN CAST(loan_id AS BIGINT) % 53 = 0 THEN 0 WHEN CAST(loan_id AS BIGINT) % 59 = 0 THEN NULL ELSE due_amt END
      AS due_amt,
    CASE WHEN CAST(loan_id AS BIGINT) % 61 = 0 OR CAST(loan_id AS BIGINT) % 67 = 0 THEN NULL ELSE overdue_amt END
      AS overdue_amt,
    CASE WHEN CAST(loan_id AS BIGINT) % 71 = 0 THEN NULL ELSE tenure END AS tenure) FROM panel),
{silver('typed')}"""

# Amounts of the text panel as they are written.
RAW_AMOUNTS = f"""{PANEL},
raw_amounts AS (
  SELECT loan_id, CASE WHEN CAST(loan_id AS BIGINT) % 53 = 0 THEN '0' WHEN CAST(loan_id AS BIGINT) % 59 <> 0 THEN CAST(due_amt AS STRING) END
      AS due_text, CAST(balance AS STRING) AS balance_text, snapshot_date FROM panel)"""

# Panel rows whose overdue amount is so large for what is due that it leads thousands of years back, or out of the calendar.
FAR = f"""{PANEL},
far AS (SELECT * REPLACE (
    CASE CAST(loan_id AS BIGINT) % 3 WHEN 0 THEN 0.25 WHEN 1 THEN 0.0009765625 ELSE 0.0000152587890625 END AS due_amt,
    CASE CAST(loan_id AS BIGINT) % 3 WHEN 0 THEN 3750.5 WHEN 1 THEN 71000 ELSE 70000 END AS overdue_amt) FROM panel)"""

ATTRIBUTES = """raw_attributes AS (
  SELECT CAST(c_custkey AS STRING) AS customer_id,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE concat('  Name', CAST(c_custkey % 700 AS STRING), ' ') END AS name,
    CASE WHEN c_custkey % 13 = 0 THEN concat(CAST(18 + c_custkey % 60 AS STRING), '_')
      WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '-500'
      ELSE CAST(10 + c_custkey % 100 AS STRING) END AS age,
    CASE WHEN c_custkey % 11 = 0 THEN '#F%$D@*&8' WHEN c_custkey % 101 = 0 THEN NULL
      ELSE concat(CAST(100 + c_custkey % 900 AS STRING), '-', CAST(10 + c_custkey % 90 AS STRING), '-',
        CAST(1000 + c_custkey % 9000 AS STRING)) END AS ssn,
    CASE WHEN c_custkey % 7 = 0 THEN '_______' WHEN c_custkey % 23 = 0 THEN '   ' WHEN c_custkey % 29 = 0 THEN NULL
      ELSE concat(' ', c_mktsegment) END AS occupation
  FROM customer)"""

CLEAN_ATTRIBUTES = f"""{ATTRIBUTES},
named AS (
  SELECT customer_id, trim(name) AS name, TRY_CAST(age AS INT) AS age,
    CASE WHEN TRY_CAST(age AS INT) >= 15 THEN 1 ELSE 0 END AS age_valid,
    CASE WHEN regexp_matches(ssn, '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') THEN 1 ELSE 0 END AS ssn_valid,
    CASE WHEN trim(occupation) IN ('_______', '') THEN NULL ELSE trim(occupation) END AS occupation
  FROM raw_attributes),
attributes AS (
  SELECT customer_id, age, occupation, ssn_valid, CASE WHEN occupation IS NULL THEN 0 ELSE 1 END AS occupation_known,
    age_valid, CASE WHEN name IS NOT NULL THEN count(*) OVER (PARTITION BY name) END AS name_shared_count,
    CASE WHEN name IS NOT NULL AND count(*) OVER (PARTITION BY name) > 1 THEN 1 ELSE 0 END AS is_name_shared
  FROM named)"""


def _measure(i: int, name: str) -> str:
    value = f"concat(CAST(c_custkey * {i} % 1000 AS STRING), '.25')"
    return (
        f"CASE WHEN (c_custkey + {i}) % 10 = 0 THEN concat({value}, '_') "
        f"WHEN (c_custkey + {i}) % 29 = 0 THEN '' ELSE {value} END AS {name}"
    )


def _count(i: int, name: str) -> str:
    value = f"CAST((c_custkey + {i}) % 10 AS STRING)"
    return (
        f"CASE WHEN (c_custkey + {i}) % 15 = 0 THEN concat({value}, '_') "
        f"WHEN (c_custkey + {i}) % 4 = 0 THEN concat({value}, '.0') ELSE {value} END AS {name}"
    )


FINANCIALS = f"""raw_financials AS (
  SELECT CAST(c_custkey AS STRING) AS customer_id,
    CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '1.2.3'
      WHEN c_custkey % 9 = 0 THEN concat(CAST(20000 + c_custkey AS STRING), '_')
      ELSE concat(CAST(20000 + c_custkey * 3 AS STRING), '.5') END AS annual_income,
    {", ".join(_measure(i, n) for i, n in enumerate(FINANCIAL_MEASURES, 1))},
    {", ".join(_count(i, n) for i, n in enumerate(FINANCIAL_COUNTS, 1))},
    CASE c_custkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NM' END AS payment_of_min_amount,
    CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 113 = 5 THEN '400000000 Years and 1 Months' WHEN c_custkey % 37 = 0 THEN concat(CAST(c_custkey % 12 AS STRING), ' Months')
      WHEN c_custkey % 39 = 0 THEN concat(CAST(c_custkey % 30 AS STRING), ' Years')
      ELSE concat(CAST(c_custkey % 30 AS STRING), ' Years and ', CAST(c_custkey % 12 AS STRING), ' Months') END
      AS credit_history_age,
    CASE c_custkey % 8 WHEN 1 THEN 'Not Specified' WHEN 2 THEN 'Auto Loan' WHEN 3 THEN 'Auto Loan, and Home Equity Loan'
      WHEN 4 THEN 'Payday Loan, Auto Loan, and Payday Loan' WHEN 5 THEN 'Home Equity Loan, Student Loan'
      WHEN 6 THEN 'Credit-Builder Loan, and Mortgage Loan'
      WHEN 7 THEN 'Student Loan, Not Specified, and Auto Loan' END AS type_of_loan,
    CASE c_custkey % 5 WHEN 0 THEN '_' WHEN 1 THEN 'Good' WHEN 2 THEN 'Bad' WHEN 3 THEN 'Standard' END AS credit_mix,
    CASE c_custkey % 6 WHEN 0 THEN '!@9#%8' WHEN 1 THEN 'High_spent_Small_value' WHEN 2 THEN 'Low_spent_Large_value'
      WHEN 4 THEN 'Low_spent_Small_value' WHEN 5 THEN 'HIGH_SPENT_SMALL_VALUE' END AS payment_behaviour
  FROM customer)"""

MEASURES = [f"CAST(TRY_CAST({n} AS FLOAT) AS DOUBLE) AS {n}" for n in FINANCIAL_MEASURES]
COUNTS = [f"TRY_CAST(regexp_extract({n}, '^([0-9]+)([.][0-9]*)?$', 1) AS INT) AS {n}" for n in FINANCIAL_COUNTS]
INCOME = "CAST(TRY_CAST(regexp_replace(annual_income, '[^0-9.]', '', 'g') AS FLOAT) AS DOUBLE) AS annual_income"
MIN_PAYMENT = "CASE WHEN payment_of_min_amount = 'Yes' THEN 1 ELSE 0 END AS payment_of_min_amount"
HISTORY = {
    "credit_history_years": "TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) Years', 1) AS INT)",
    "credit_history_months": "TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) Months', 1) AS INT)",
    "credit_history_total_months": "TRY_CAST(CAST(TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) Years', 1) AS INT)"
    " AS BIGINT) * 12 + coalesce(TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) Months', 1) AS INT), 0) AS INT)",
}
ITEMS = ["Auto Loan", "Credit-Builder Loan", "Home Equity Loan", "Not Specified", "Payday Loan", "Student Loan"]
ITEM_FLAGS = [
    f"CASE WHEN contains(type_of_loan, '{i}') THEN 1 ELSE 0 END AS {i.replace(' ', '_').replace('-', '_').lower()}"
    for i in ITEMS
]
MIX_FLAGS = [f"CASE WHEN credit_mix = '{m}' THEN 1 ELSE 0 END AS credit_mix_{m.lower()}" for m in ("Good", "Bad", "Standard")]
MIX_VALID = "CASE WHEN credit_mix IN ('Good', 'Standard', 'Bad') THEN 1 ELSE 0 END AS valid_credit_mix"
BEHAVIOURS = ["0", "high_spent_small_value", "low_spent_large_value", "low_spent_small_value"]
BEHAVIOUR = "CASE WHEN lower(payment_behaviour) = '!@9#%8' THEN '0' ELSE lower(payment_behaviour) END"
BEHAVIOUR_FLAGS = [f"CAST({BEHAVIOUR} = '{b}' AS INT) AS pb_{b}" for b in BEHAVIOURS]

GOLD_FINANCIAL_COLUMNS = ",\n    ".join(
    [
        INCOME,
        *MEASURES,
        *COUNTS,
        MIN_PAYMENT,
        f"{HISTORY['credit_history_total_months']} AS credit_history_total_months",
        *ITEM_FLAGS,
        *MIX_FLAGS,
        MIX_VALID,
        "CAST(payment_behaviour IS NOT NULL AS INT) AS has_valid_payment_behavior",
        *BEHAVIOUR_FLAGS,
    ]
)
CLEAN_FINANCIALS = f"""{FINANCIALS},
financials AS (SELECT customer_id, {GOLD_FINANCIAL_COLUMNS} FROM raw_financials)"""

CLICKS = f"""clicks AS (
  SELECT CAST(user_id AS STRING) AS customer_id,
    CAST(DATE '1996-01-01' + to_months(CAST(day(ts) AS INT) - 1) AS DATE) AS snapshot_date,
    {", ".join(
        f"CAST(sum(CASE WHEN event_type = '{k}' AND hour(ts) >= {6 * q} AND hour(ts) < {6 * q + 6} "
        f"THEN CAST(floor(value) AS INT) END) AS INT) AS fe_{4 * i + q + 1}"
        for i, k in enumerate(KINDS) for q in range(4)
    )}
  FROM events GROUP BY 1, 2)"""

DIRTY_CLICKS = f"""{CLICKS},
raw_clicks AS (SELECT * REPLACE (
    CASE WHEN CAST(customer_id AS BIGINT) % 50 <> 0 THEN customer_id END AS customer_id,
    CASE WHEN CAST(customer_id AS BIGINT) % 41 <> 0 THEN snapshot_date END AS snapshot_date,
    CASE WHEN CAST(customer_id AS BIGINT) % 7 <> 0 THEN fe_1 END AS fe_1) FROM clicks)"""

PROFILE_COLUMNS = ", ".join(
    f"round(avg({f}), 6) AS {f}_mean, round(stddev_samp({f}), 6) AS {f}_std, min({f}) AS {f}_min, max({f}) AS {f}_max"
    for f in FE
)
DELTA_COLUMNS = ", ".join(
    f"arg_max_null({f}, snapshot_date) - arg_min_null({f}, snapshot_date) AS {f}_delta" for f in FE
)
PROFILE = f"profile AS (SELECT customer_id, {PROFILE_COLUMNS}, {DELTA_COLUMNS} FROM clicks GROUP BY customer_id)"


def months_between(end: str, start: str) -> str:
    return f"""round((year({end}) - year({start})) * 12 + (month({end}) - month({start}))
      + CASE WHEN day({end}) = day({start}) OR ({end} = last_day({end}) AND {start} = last_day({start})) THEN 0
             ELSE (day({end}) - day({start})) / 31.0 END, 8)"""


VINTAGE = f"""CASE WHEN {months_between('latest_snapshot_date', 'started')} < 3 THEN 'new'
      WHEN {months_between('latest_snapshot_date', 'started')} < 6 THEN 'mid' ELSE 'old' END"""

TOTALS = """totals AS (
  SELECT loan_id, sum(paid_amt) AS total_paid_amt,
    CAST(sum(CASE WHEN overdue_amt > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_months_overdue,
    max(snapshot_date) AS latest_snapshot_date, min(loan_start_date) AS started
  FROM loans GROUP BY loan_id),
latest AS (SELECT * EXCLUDE (newest) FROM (SELECT *,
    row_number() OVER (PARTITION BY loan_id ORDER BY snapshot_date DESC, installment_num DESC) AS newest FROM loans)
  WHERE newest = 1)"""

LOAN_FEATURES = f"""{TOTALS},
aged AS (SELECT *, {VINTAGE} AS vintage FROM totals),
loan_features AS (
  SELECT l.loan_id, l.snapshot_date, l.customer_id, l.tenure, l.installment_num, l.loan_amt, l.overdue_amt, l.balance,
    l.mob, l.installments_missed, l.dpd, a.total_paid_amt, a.num_months_overdue,
    CAST(month(a.started) AS INT) AS loan_start_month, CAST(year(a.started) AS INT) AS loan_start_year,
    CASE WHEN vintage = 'old' THEN 1 ELSE 0 END AS loan_vintage_old,
    CASE WHEN vintage = 'mid' THEN 1 ELSE 0 END AS loan_vintage_mid,
    CASE WHEN vintage = 'new' THEN 1 ELSE 0 END AS loan_vintage_new,
    CASE WHEN l.overdue_amt > 0 THEN 1 ELSE 0 END AS has_overdue_amt,
    CASE WHEN l.first_missed_date IS NOT NULL THEN 1 ELSE 0 END AS has_missed_payment
  FROM latest l JOIN aged a ON l.loan_id = a.loan_id)"""

MATRIX = f"""matrix AS (
  SELECT p.*, f.* EXCLUDE (customer_id), a.* EXCLUDE (customer_id), n.* EXCLUDE (customer_id)
  FROM profile p LEFT JOIN loan_features f ON p.customer_id = f.customer_id
    LEFT JOIN attributes a ON f.customer_id = a.customer_id
    LEFT JOIN financials n ON f.customer_id = n.customer_id)"""

FEATURES = """store AS (
  SELECT l.loan_id, l.customer_id, l.tenure, l.installment_num, l.loan_amt, l.overdue_amt, l.balance, l.snapshot_date,
    l.installments_missed, CASE WHEN l.overdue_amt > 0 THEN 1 ELSE 0 END AS has_overdue_amt,
    CASE WHEN l.first_missed_date IS NOT NULL THEN 1 ELSE 0 END AS has_missed_payment,
    a.* EXCLUDE (customer_id), f.* EXCLUDE (customer_id), c.* EXCLUDE (customer_id, snapshot_date)
  FROM loans l LEFT JOIN attributes a ON l.customer_id = a.customer_id
    LEFT JOIN financials f ON l.customer_id = f.customer_id
    LEFT JOIN clicks c ON l.customer_id = c.customer_id AND l.snapshot_date = c.snapshot_date
  WHERE l.mob = 6)"""
