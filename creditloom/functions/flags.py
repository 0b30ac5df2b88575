"""0/1 flags and sentinel handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is NULL."""
    return F.when(condition, 1).otherwise(0)


def null_if_in(value: Column, sentinels: Sequence[str]) -> Column:
    """NULL for any of the sentinel values, the value itself otherwise."""
    return F.when(value.isin(list(sentinels)), None).otherwise(value)
