"""Silver tables: typed and cleaned, one row per source row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from creditloom.functions.casts import retype
from creditloom.operators.cleaning import (
    MISSING_CREDIT_MIX,
    duration_months,
    flag_pattern,
    known_occupation,
    null_sentinels,
    numeric_text,
    payment_behaviour,
    trim_text,
    typed_clicks,
    valid_age,
    yes_flag,
)
from creditloom.operators.delinquency import days_past_due, installments_missed, month_on_book
from creditloom.operators.duplicates import shared_count
from creditloom.operators.encoding import (
    MAX_VOCABULARY,
    credit_mix_flags,
    learn_both,
    learn_items,
    learn_levels,
    multi_hot,
    one_hot,
)
from creditloom.sources.schemas import (
    CLICK_FEATURES,
    CUSTOMER,
    FINANCIAL_COUNTS,
    FINANCIAL_MEASURES,
    SNAPSHOT,
    click_types,
    financial_types,
    loan_types,
)


def silver_loans(raw: DataFrame, money: str = "float", fill: Sequence[str] | None = None) -> DataFrame:
    """Typed loan panel with month on book, missed installments, first missed date and days past due."""
    typed = retype(raw, loan_types(money))
    return typed.transform(month_on_book).transform(installments_missed, fill=fill).transform(days_past_due)


def silver_clicks(raw: DataFrame, features: Sequence[str] = CLICK_FEATURES) -> DataFrame:
    """Integer click features with NOT NULL customer and snapshot."""
    return typed_clicks(raw, click_types(list(features)), [CUSTOMER, SNAPSHOT])


def silver_attributes(raw: DataFrame) -> DataFrame:
    """Customer attributes with validity flags and shared-name counts, without name and SSN."""
    return (
        raw.transform(known_occupation)
        .transform(trim_text, "name")
        .transform(flag_pattern)
        .transform(valid_age)
        .transform(shared_count)
        .drop("name", "ssn")
    )


def clean_financials(raw: DataFrame, junk_as: str | None = "0") -> DataFrame:
    """Typed financial measures and cleaned categories, before any encoding."""
    present = [c for c in [*FINANCIAL_MEASURES, *FINANCIAL_COUNTS] if c in raw.columns]
    types = financial_types()
    return (
        retype(raw, {c: types[c] for c in present})
        .transform(numeric_text)
        .transform(yes_flag)
        .transform(duration_months)
        .transform(null_sentinels, "credit_mix", MISSING_CREDIT_MIX)
        .transform(payment_behaviour, junk_as=junk_as)
    )


def learn_vocabularies(raw: DataFrame, junk_as: str | None = "0", limit: int = MAX_VOCABULARY) -> list[list[str]]:
    """Loan items and payment behaviours of the raw financials, in one small job."""
    return learn_both(clean_financials(raw, junk_as), "type_of_loan", "payment_behaviour", limit)


def silver_financials(
    raw: DataFrame,
    items: Sequence[str] | None = None,
    behaviours: Sequence[str] | None = None,
    junk_as: str | None = "0",
    max_vocabulary: int = MAX_VOCABULARY,
) -> DataFrame:
    """Customer financials with encoded loan types, credit mix and payment behaviour.

    Vocabularies not passed in are learned from the data in one small job, and fail beyond `max_vocabulary` values each.
    """
    cleaned = clean_financials(raw, junk_as)
    if items is None and behaviours is None:
        items, behaviours = learn_both(cleaned, "type_of_loan", "payment_behaviour", max_vocabulary)
    items = learn_items(raw, limit=max_vocabulary) if items is None else items
    behaviours = learn_levels(cleaned, limit=max_vocabulary) if behaviours is None else behaviours
    return (
        cleaned.transform(multi_hot, "type_of_loan", items)
        .transform(credit_mix_flags)
        .transform(one_hot, "payment_behaviour", behaviours, "pb_")
        .drop("credit_history_age", "type_of_loan")
    )
