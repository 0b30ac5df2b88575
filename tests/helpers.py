from __future__ import annotations

from collections import Counter


def bag(df, columns=None):
    """Rows as a multiset, columns in a fixed order."""
    columns = sorted(columns or df.columns)
    return Counter(tuple(row) for row in df.select(columns).collect())


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_text(df) -> str:
    """The plan after adaptive execution."""
    df.collect()
    return plan_text(df)
