"""Row and NULL counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.casts import quoted


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs in each column."""
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(f"{c}_nulls") for c in columns])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def row_audit(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"))


def catalog_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every named frame."""
    counted = [row_count(df).select(F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counted)
