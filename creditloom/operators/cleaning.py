"""Cleaning of dirty text columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.casts import backticked, digits_to_float, quoted, retype, tolerant_cast
from creditloom.functions.flags import flag, null_if_in

# Text patterns and sentinels of the source data.
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
BLANK_OCCUPATIONS = ["_______", ""]
MISSING_CREDIT_MIX = ["_"]
MISSING_LOAN_TYPE = ["NULL", "Not Specified"]
JUNK_PAYMENT_BEHAVIOUR = "!@9#%8"
YEARS_PATTERN = r"(\d+) Years"
MONTHS_PATTERN = r"(\d+) Months"
MIN_AGE = 15


def trim_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns})


def null_sentinels(df: DataFrame, column: str, sentinels: Sequence[str], trim: bool = False) -> DataFrame:
    value = F.trim(column) if trim else F.col(column)
    return df.withColumn(column, null_if_in(value, sentinels))


def known_occupation(df: DataFrame, column: str = "occupation", out: str = "occupation_known") -> DataFrame:
    """Trim, turn blanks to NULL, and flag what is left."""
    cleaned = null_sentinels(df, column, BLANK_OCCUPATIONS, trim=True)
    return cleaned.withColumn(out, flag(F.col(column).isNotNull()))


def flag_pattern(df: DataFrame, column: str = "ssn", out: str = "ssn_valid", pattern: str = SSN_PATTERN) -> DataFrame:
    return df.withColumn(out, flag(F.col(column).rlike(pattern)))


def mask_pattern(df: DataFrame, column: str = "ssn", out: str = "ssn_valid", pattern: str = SSN_PATTERN) -> DataFrame:
    """Turn values that break the pattern to NULL, and flag the others."""
    masked = df.withColumn(column, F.when(F.col(column).rlike(pattern), F.col(column)))
    return masked.withColumn(out, flag(F.col(column).isNotNull()))


def valid_age(
    df: DataFrame,
    column: str = "age",
    out: str = "age_valid",
    min_age: int = MIN_AGE,
    max_age: int | None = None,
) -> DataFrame:
    """Age as int with a plausibility flag; implausible ages stay in the column. No upper bound by default."""
    age = tolerant_cast(F.col(column), df.schema[column].dataType, "int")
    plausible = age >= min_age if max_age is None else age.between(min_age, max_age)
    return df.withColumns({column: age, out: flag(plausible)})


def keep_age_range(
    df: DataFrame, column: str = "age", out: str = "age_int", min_age: int = MIN_AGE, max_age: int = 100
) -> DataFrame:
    """Rows whose age lies in the closed range, with the age as int."""
    typed = df.withColumn(out, tolerant_cast(F.col(column), df.schema[column].dataType, "int"))
    return typed.where(F.col(out).between(min_age, max_age))


def numeric_text(df: DataFrame, column: str = "annual_income") -> DataFrame:
    return df.withColumn(column, digits_to_float(F.col(column).cast("string")))


def yes_flag(df: DataFrame, column: str = "payment_of_min_amount", yes: str = "Yes") -> DataFrame:
    return df.withColumn(column, flag(F.col(column) == yes))


def duration_months(df: DataFrame, column: str = "credit_history_age", prefix: str = "credit_history") -> DataFrame:
    """Years, months and total months of text like '22 Years and 1 Months'.

    No years give a NULL total, no months count as zero. A total that overflows is NULL.
    """
    years = F.regexp_extract(column, YEARS_PATTERN, 1).try_cast("int")
    months = F.regexp_extract(column, MONTHS_PATTERN, 1).try_cast("int")
    return df.withColumns(
        {
            f"{prefix}_years": years,
            f"{prefix}_months": months,
            f"{prefix}_total_months": F.try_add(F.try_multiply(years, F.lit(12)), F.coalesce(months, F.lit(0))),
        }
    )


def payment_behaviour(
    df: DataFrame,
    column: str = "payment_behaviour",
    out: str = "has_valid_payment_behavior",
    junk_as: str | None = "0",
) -> DataFrame:
    """Lower-case, replace the junk token, and flag values that are not NULL. `junk_as=None` voids junk."""
    lowered = F.lower(column)
    cleaned = F.when(lowered == JUNK_PAYMENT_BEHAVIOUR, F.lit(junk_as)).otherwise(lowered)
    return df.withColumn(column, cleaned).withColumn(out, F.col(column).isNotNull().cast("int"))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL key and declare the keys NOT NULL in the schema."""
    present = df.na.drop(subset=list(keys))
    required = set(keys)
    return present.select(
        [_never_null(field) if field.name in required else backticked(field.name) for field in present.schema.fields]
    )


def _never_null(field: T.StructField) -> Column:
    """The column typed as non-nullable; the literal at the end only serves the type and is never reached."""
    failure = F.raise_error(F.lit(f"NULL in key column {field.name}")).cast(field.dataType)
    literals = {T.StringType: "", T.DateType: dt.date(1970, 1, 1), T.TimestampType: dt.datetime(1970, 1, 1)}
    zero = F.lit(literals.get(type(field.dataType), 0)).cast(field.dataType)
    return F.coalesce(quoted(field.name), failure, zero).alias(field.name)


def typed_clicks(df: DataFrame, types: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """Typed projection of a click table: feature columns as int, then the NOT NULL keys."""
    return require_keys(retype(df.select(*types), types), keys)
