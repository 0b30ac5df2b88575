"""Result shaping for comparison: FLOAT widened to DOUBLE, means and deviations rounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def widened(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType) else f.name
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, endings: tuple[str, ...] = ("_mean", "_std"), digits: int = 6) -> DataFrame:
    return df.select([F.round(c, digits).alias(c) if c.endswith(endings) else c for c in df.columns])
