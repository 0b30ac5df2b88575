"""The source tables of the mart, derived from the star-schema test tables.

Loans are orders, the monthly panel is their line items by line number, attributes and financials are
customers with dirt by rule, and clicks are events with days standing in for months. Amounts are whole numbers or
quarters, so sums and ratios are exact in any order and in FLOAT. The oracle builds the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.schemas import FINANCIAL_COUNTS, FINANCIAL_MEASURES, LOAN_AMOUNTS, LOAN_COUNTS, SNAPSHOT

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
DAY_QUARTERS = 4  # five event types by four quarters of the day make the twenty click features
PANEL_TENURE = 7
FIRST_CLICK_MONTH = "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed loan panel: one row per order and line number.

    Line items are added up before they meet their order, so an order with very many lines is combined
    before the shuffle and brings at most one row per line number to the join.
    """
    discount_points = F.round(F.col("l_discount") * 100).cast("int")
    late = F.when(F.col("l_linestatus") == "O", F.col("l_quantity") * discount_points).otherwise(0)
    installments = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum("l_quantity").alias("due_amt"), (F.sum(late) / 4).alias("overdue_amt"))
    )
    started = F.col("o_orderdate").cast("date")
    snapshot = F.trunc(F.add_months(started, F.col("l_linenumber")), "MM")
    amount = F.floor("o_totalprice").cast("double")
    orders = table(spark, sf_dir, "orders")
    return orders.join(installments, orders.o_orderkey == installments.l_orderkey).select(
        F.col("o_orderkey").cast("string").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        started.alias("loan_start_date"),
        F.lit(PANEL_TENURE).alias("tenure"),
        F.col("l_linenumber").alias("installment_num"),
        amount.alias("loan_amt"),
        "due_amt",
        (F.col("due_amt") * 4 - F.col("overdue_amt")).alias("paid_amt"),
        "overdue_amt",
        (amount - F.col("due_amt")).alias("balance"),
        snapshot.alias(SNAPSHOT),
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as text, with missing and zero amounts, amounts that are no numbers, and '3.0' for 3."""
    loan = F.col("loan_id").cast("bigint")
    text = {c: F.col(c).cast("string") for c in [*LOAN_COUNTS, *LOAN_AMOUNTS, "loan_start_date", SNAPSHOT]}
    dirt = {
        "due_amt": F.when(loan % 53 == 0, "0").when(loan % 59 == 0, None).otherwise(text["due_amt"]),
        "overdue_amt": F.when(loan % 61 == 0, None).when(loan % 67 == 0, "n/a").otherwise(text["overdue_amt"]),
        "installment_num": F.when(loan % 2 == 0, F.concat(text["installment_num"], F.lit(".0"))).otherwise(
            text["installment_num"]
        ),
        "tenure": F.when(loan % 71 == 0, "_").otherwise(text["tenure"]),
    }
    return loan_panel(spark, sf_dir).withColumns({**text, **dirt})


def _custkey(every: int) -> Column:
    return F.col("c_custkey") % every


def _number(value: Column) -> Column:
    return value.cast("string")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    ssn = F.concat_ws(
        "-", _number(_custkey(900) + 100), _number(_custkey(90) + 10), _number(_custkey(9000) + 1000)
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("customer_id"),
        F.when(_custkey(97) != 0, F.concat(F.lit("  Name"), _number(_custkey(700)), F.lit(" "))).alias("name"),
        F.when(_custkey(13) == 0, F.concat(_number(_custkey(60) + 18), F.lit("_")))
        .when(_custkey(17) == 0, None)
        .when(_custkey(19) == 0, "-500")
        .otherwise(_number(_custkey(100) + 10))
        .alias("age"),
        F.when(_custkey(11) == 0, "#F%$D@*&8").when(_custkey(101) != 0, ssn).alias("ssn"),
        F.when(_custkey(7) == 0, "_______")
        .when(_custkey(23) == 0, "   ")
        .when(_custkey(29) != 0, F.concat(F.lit(" "), F.col("c_mktsegment")))
        .alias("occupation"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    years = F.concat(_number(_custkey(30)), F.lit(" Years"))
    months = F.concat(_number(_custkey(12)), F.lit(" Months"))
    loan_lists = {
        1: "Not Specified",
        2: "Auto Loan",
        3: "Auto Loan, and Home Equity Loan",
        4: "Payday Loan, Auto Loan, and Payday Loan",
        5: "Home Equity Loan, Student Loan",
        6: "Credit-Builder Loan, and Mortgage Loan",
        7: "Student Loan, Not Specified, and Auto Loan",
    }
    mixes = {0: "_", 1: "Good", 2: "Bad", 3: "Standard"}
    behaviours = {
        0: "!@9#%8",
        1: "High_spent_Small_value",
        2: "Low_spent_Large_value",
        4: "Low_spent_Small_value",
        5: "HIGH_SPENT_SMALL_VALUE",
    }
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("customer_id"),
        F.when(_custkey(41) == 0, None)
        .when(_custkey(43) == 0, "1.2.3")
        .when(_custkey(9) == 0, F.concat(_number(key + 20000), F.lit("_")))
        .otherwise(F.concat(_number(key * 3 + 20000), F.lit(".5")))
        .alias("annual_income"),
        *[_measure(key, i).alias(name) for i, name in enumerate(FINANCIAL_MEASURES, 1)],
        *[_count(key, i).alias(name) for i, name in enumerate(FINANCIAL_COUNTS, 1)],
        _by_rest(4, {0: "Yes", 1: "No", 2: "NM"}).alias("payment_of_min_amount"),
        F.when(_custkey(31) == 0, None)
        .when(_custkey(113) == 5, "400000000 Years and 1 Months")
        .when(_custkey(37) == 0, months)
        .when(_custkey(39) == 0, years)
        .otherwise(F.concat(years, F.lit(" and "), months))
        .alias("credit_history_age"),
        _by_rest(8, loan_lists).alias("type_of_loan"),
        _by_rest(5, mixes).alias("credit_mix"),
        _by_rest(6, behaviours).alias("payment_behaviour"),
    )


def _measure(key: Column, i: int) -> Column:
    """A quarter-valued number; every tenth carries an underscore and every 29th is empty."""
    value = F.concat(_number(key * i % 1000), F.lit(".25"))
    return F.when((key + i) % 10 == 0, F.concat(value, F.lit("_"))).when((key + i) % 29 == 0, "").otherwise(value)


def _count(key: Column, i: int) -> Column:
    """A small count; some carry an underscore, some a decimal point."""
    value = _number((key + i) % 10)
    return (
        F.when((key + i) % 15 == 0, F.concat(value, F.lit("_")))
        .when((key + i) % 4 == 0, F.concat(value, F.lit(".0")))
        .otherwise(value)
    )


def _by_rest(every: int, values: dict[int, str]) -> Column:
    chosen = F
    for rest, value in values.items():
        chosen = chosen.when(_custkey(every) == rest, value)
    return chosen


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty integer click features per customer and month; NULL where the customer had no such event."""
    day = F.dayofmonth("ts")
    snapshot = F.add_months(F.lit(FIRST_CLICK_MONTH).cast("date"), day - 1)
    quarter = F.floor(F.hour("ts") / (24 // DAY_QUARTERS))
    amount = F.floor("value").cast("int")
    cells = [(kind, part) for kind in EVENT_TYPES for part in range(DAY_QUARTERS)]
    features = [
        F.sum(F.when((F.col("event_type") == kind) & (quarter == part), amount)).cast("int").alias(f"fe_{i}")
        for i, (kind, part) in enumerate(cells, 1)
    ]
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("customer_id"), snapshot.alias(SNAPSHOT))
        .agg(*features)
    )


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click table as text, with missing customers, dates that are none, and features that are no numbers."""
    base = clicks(spark, sf_dir)
    key = F.col("customer_id").cast("bigint")
    text = {c: F.col(c).cast("string") for c in base.columns}
    dirt = {
        "customer_id": F.when(key % 50 != 0, F.col("customer_id")),
        SNAPSHOT: F.when(key % 41 == 0, "unknown").otherwise(text[SNAPSHOT]),
        "fe_1": F.when(key % 7 == 0, "x").otherwise(text["fe_1"]),
        "fe_2": F.concat(text["fe_2"], F.lit(".9")),
    }
    return base.select([dirt.get(c, text[c]).alias(c) for c in base.columns])
