"""Columns and types of the four source tables (fixed values of the data model)."""

SNAPSHOT = "snapshot_date"
CUSTOMER = "customer_id"

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]

LOAN_IDS = ["loan_id", "customer_id"]
LOAN_DATES = ["loan_start_date", "snapshot_date"]
LOAN_COUNTS = ["tenure", "installment_num"]
LOAN_AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]

FINANCIAL_MEASURES = [
    "monthly_inhand_salary",
    "interest_rate",
    "delay_from_due_date",
    "num_of_delayed_payment",
    "changed_credit_limit",
    "num_credit_inquiries",
    "outstanding_debt",
    "credit_utilization_ratio",
    "total_emi_per_month",
    "amount_invested_monthly",
    "monthly_balance",
]
FINANCIAL_COUNTS = ["num_bank_accounts", "num_credit_card", "num_of_loan"]

MONTHLY_TABLES = ["feature_clickstream", "lms_loan_daily"]
STATIC_TABLES = ["features_attributes", "features_financials"]


def loan_types(money: str = "float") -> dict[str, str]:
    """Type of every loan column. `money="decimal(12,2)"` keeps whole overdue/due ratios exact."""
    return (
        dict.fromkeys(LOAN_IDS, "string")
        | dict.fromkeys(LOAN_DATES, "date")
        | dict.fromkeys(LOAN_COUNTS, "int")
        | dict.fromkeys(LOAN_AMOUNTS, money)
    )


def click_types(features: list[str] = CLICK_FEATURES) -> dict[str, str]:
    return dict.fromkeys(features, "int") | {CUSTOMER: "string", SNAPSHOT: "date"}


def financial_types() -> dict[str, str]:
    return dict.fromkeys(FINANCIAL_MEASURES, "float") | dict.fromkeys(FINANCIAL_COUNTS, "int")
