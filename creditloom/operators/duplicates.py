"""Values shared by several rows, and keys that repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.casts import backticked
from creditloom.functions.flags import flag
from creditloom.operators.skew import LISTED_KEYS, ROWS_PER_TASK


def shared_count(
    df: DataFrame,
    column: str = "name",
    count: str = "name_shared_count",
    shared: str = "is_name_shared",
    rows_per_task: int = ROWS_PER_TASK,
    listed_values: int = LISTED_KEYS,
) -> DataFrame:
    """How many rows carry the same value, and whether more than one does.

    NULL is not a value: its rows get a NULL count and flag 0. The counts are joined back instead of taken
    over a window, which would put all rows of a common value into one task. The counts themselves tell which values
    are common: the `listed_values` most frequent ones above `rows_per_task` come by broadcast, as hashes of 128 bits so that long values
    don't matter, and all rows without one of these, NULL rows aside, by a plain join.
    """
    hashes = {"__h1": F.xxhash64(column), "__h2": F.xxhash64(F.lit(1), column)}
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))
    common = counts.where(F.col(count) > rows_per_task).orderBy(F.desc(count), column).limit(listed_values)
    listed = common.withColumns(hashes).select(*hashes, F.col(count).alias("__common"))
    marked = df.withColumns(hashes).join(F.broadcast(listed), list(hashes), "left")
    # A row whose count is known, or that has no value, is dealt out by itself and meets nothing in the join.
    settled = F.col("__common").isNotNull() | F.col(column).isNull()
    rows = marked.withColumn("__value", F.when(~settled, F.col(column)))
    rows = rows.withColumn("__spread", F.when(settled, F.xxhash64(*[backticked(c) for c in df.columns])).otherwise(F.lit(0)))
    others = counts.select(F.col(column).alias("__name"), F.col(count).alias("__count"), F.lit(0).cast("bigint").alias("__zero"))
    same = (F.col("__value") == F.col("__name")) & (F.col("__spread") == F.col("__zero"))
    joined = rows.join(others, same, "left")
    total = F.coalesce("__common", "__count")
    return joined.select(*[backticked(c) for c in df.columns], total.alias(count), flag(total > 1).alias(shared))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, most frequent first, ties by value. NULL counts as a value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc_nulls_first(column))


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values; sort and limit run as one top-k without a full sort."""
    return value_counts(df, column).limit(k)


def keys_with_many(
    df: DataFrame, key: str | Sequence[str], counted: str, out: str = "no_of_loans", more_than: int = 1
) -> DataFrame:
    """Keys with more than `more_than` non-NULL values of a column."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(counted).alias(out)).where(F.col(out) > more_than)


def assert_unique(df: DataFrame, *keys: str) -> None:
    """Raise if a key occurs twice; only one offending key comes to the driver."""
    counted = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    repeated = counted.where(F.col("__rows") > 1).take(1)
    if repeated:
        raise ValueError(f"key {keys} is not unique, for example {repeated[0].asDict()}")
