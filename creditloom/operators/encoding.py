"""One-hot and multi-hot columns, with vocabularies learned from the data or passed in.

Learning runs while a query is put together, since the columns depend on it. It brings at most `limit` short
values to the driver and fails beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.flags import flag

# List separator, and items that repeat the conjunction before the last list element.
SEPARATOR = r",\s*"
CONJUNCTION = r"(?i)^and\b.*"
CONJUNCTION_WORD = r"(?i)^and\b\s*"

CREDIT_MIX_LEVELS = ["Good", "Bad", "Standard"]
MAX_VOCABULARY = 1_000


def list_items(df: DataFrame, column: str, separator: str = SEPARATOR, strip_conjunction: bool = False) -> DataFrame:
    """Distinct items of a delimited list, as one column `item`.

    Items that start with "and" are left out; `strip_conjunction` keeps them without the word instead.
    """
    item = F.trim(F.col("item"))
    items = df.where(F.col(column).isNotNull()).select(F.explode(F.split(F.col(column), separator)).alias("item"))
    if strip_conjunction:
        items = items.select(F.trim(F.regexp_replace(item, CONJUNCTION_WORD, "")).alias("item"))
    else:
        items = items.select(item.alias("item")).where(~F.col("item").rlike(CONJUNCTION))
    return items.where(F.col("item") != "").distinct()


def levels(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column without NULL."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def learn(*values: DataFrame, limit: int = MAX_VOCABULARY) -> list[list[str]]:
    """Sorted texts of each one-column frame, in one job; more than `limit` in any are an error."""
    tagged = [
        df.limit(limit + 1).select(F.lit(i).alias("vocabulary"), F.col(df.columns[0]).cast("string").alias("value"))
        for i, df in enumerate(values)
    ]
    found: list[list[str]] = [[] for _ in values]
    for row in reduce(DataFrame.unionAll, tagged).collect():
        found[row.vocabulary].append(row.value)
    for df, vocabulary in zip(values, found):
        if len(vocabulary) > limit:
            raise ValueError(f"more than {limit} distinct values of {df.columns[0]}; pass the vocabulary")
    return [sorted(vocabulary) for vocabulary in found]


def learn_both(df: DataFrame, listed: str, single: str, limit: int = MAX_VOCABULARY) -> list[list[str]]:
    """Items of the lists in one column and levels of another, from a single scan."""
    parts = F.transform(F.split(F.col(listed), SEPARATOR), lambda part: F.trim(part))
    items = F.filter(parts, lambda part: (part != "") & ~part.rlike(CONJUNCTION))
    tagged = F.concat(
        F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda item: F.struct(F.lit(0).alias("vocabulary"), item.alias("value"))),
        F.array(F.struct(F.lit(1).alias("vocabulary"), F.col(single).cast("string").alias("value"))),
    )
    found = df.select(F.explode(tagged).alias("x")).select("x.*").where(F.col("value").isNotNull()).distinct()
    out: list[list[str]] = [[], []]
    for row in found.limit(2 * limit + 1).collect():
        out[row.vocabulary].append(row.value)
    for column, vocabulary in zip((listed, single), out):
        if len(vocabulary) > limit:
            raise ValueError(f"more than {limit} distinct values of {column}; pass the vocabulary")
    return [sorted(vocabulary) for vocabulary in out]


def learn_items(df: DataFrame, column: str = "type_of_loan", limit: int = MAX_VOCABULARY, **options) -> list[str]:
    return learn(list_items(df, column, **options), limit=limit)[0]


def learn_levels(df: DataFrame, column: str = "payment_behaviour", limit: int = MAX_VOCABULARY) -> list[str]:
    return learn(levels(df, column), limit=limit)[0]


def item_column(item: str) -> str:
    """Column name of an item: blanks and hyphens become underscores."""
    return item.replace(" ", "_").replace("-", "_").lower()


def multi_hot(
    df: DataFrame, column: str, items: Sequence[str], exact: bool = False, separator: str = SEPARATOR
) -> DataFrame:
    """One 0/1 column per item, all in one projection.

    An item counts as present when its text occurs anywhere in the list, so a name inside a longer one sets
    both. `exact` compares whole items, with a leading "and" removed.
    """
    if exact:
        parts = F.transform(
            F.split(F.col(column), separator), lambda part: F.regexp_replace(F.trim(part), CONJUNCTION_WORD, "")
        )
        return _add(df, [(item_column(i), flag(F.array_contains(parts, i))) for i in items])
    return _add(df, [(item_column(i), flag(F.col(column).contains(i))) for i in items])


def one_hot(
    df: DataFrame, column: str, values: Sequence[str], prefix: str, null_as: int | None = None
) -> DataFrame:
    """One 0/1 column per value, named prefix plus value. A NULL input gives `null_as` in every column."""

    def hot(value: str) -> Column:
        equal = (F.col(column) == value).cast("int")
        return equal if null_as is None else F.coalesce(equal, F.lit(null_as))

    return _add(df, [(f"{prefix}{value}".lower(), hot(value)) for value in values])


def credit_mix_flags(df: DataFrame, column: str = "credit_mix") -> DataFrame:
    """0/1 columns for the three known levels and one for any of them; NULL gives 0."""
    encoded = one_hot(df, column, CREDIT_MIX_LEVELS, f"{column}_", null_as=0)
    return encoded.withColumn(f"valid_{column}", flag(F.col(column).isin(CREDIT_MIX_LEVELS)))


def _add(df: DataFrame, columns: list[tuple[str, Column]]) -> DataFrame:
    names = [name for name, _ in columns]
    clash = sorted({n for n in names if names.count(n) > 1} | ({c.lower() for c in df.columns} & set(names)))
    if clash:
        raise ValueError(f"encoded columns clash: {clash}")
    return df.withColumns(dict(columns)) if columns else df
