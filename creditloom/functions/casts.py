"""Casts that turn bad input into NULL, written out so that they work with ANSI mode on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers with a decimal point in text: digits before it, or none. Blanks and control characters may surround them.
WHOLE_AND_FRACTION = r"^[\x00-\x20\x7F]*[+-]?\d+\.\d*[\x00-\x20\x7F]*$"
FRACTION_ONLY = r"^[\x00-\x20\x7F]*[+-]?\.\d*[\x00-\x20\x7F]*$"

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def text_to_int(text: Column, kind: str = "int") -> Column:
    """Whole part of a number in text: '15.7' is 15 and '.5' is 0. Other text and overflow are NULL.

    A bare `try_cast` would reject every value with a decimal point. Plain digits take it all the same; only
    what it rejects is matched against a pattern. The expression is kept short, as tables have dozens of such
    columns and generated code beyond the JVM's limit for compiled methods runs several times slower.
    """
    before_point = F.substring_index(text, ".", 1).try_cast(kind)
    return F.coalesce(
        text.try_cast(kind),
        F.when(text.rlike(WHOLE_AND_FRACTION), before_point),
        F.when(text.rlike(FRACTION_ONLY), F.lit(0).cast(kind)),
    )


def text_to_date(text: Column, fmt: str | None = None) -> Column:
    """Date in text, in ISO form or by a pattern such as 'dd/MM/yyyy'; NULL where it doesn't fit."""
    return F.try_to_date(text) if fmt is None else F.try_to_date(text, fmt)


def tolerant_cast(value: Column, source: T.DataType, target: str) -> Column:
    """`value` of type `source` as `target`, NULL where it does not fit."""
    if target in WHOLE_TYPES and isinstance(source, T.StringType):
        return text_to_int(value, target)
    return value.try_cast(target)


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Apply a {column: type} map in one projection, leaving the other columns and the order as they are."""
    wanted = {name.lower(): kind for name, kind in types.items()}
    absent = wanted.keys() - {name.lower() for name in df.columns}
    if absent:
        raise ValueError(f"columns to retype are missing: {sorted(absent)}")
    out = []
    for field in df.schema.fields:
        kind = wanted.get(field.name.lower())
        name = backticked(field.name)
        out.append(tolerant_cast(F.col(name), field.dataType, kind).alias(field.name) if kind else name)
    return df.select(out)


def digits_to_float(text: Column) -> Column:
    """Float from text after removing everything but digits and dots; sign and exponent are lost by design."""
    return F.regexp_replace(text, r"[^0-9.]", "").try_cast("float")


def backticked(name: str) -> str:
    """A literal column name as `select` takes it, also when it holds dots or other special characters."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    return F.col(backticked(name))
