"""What tests look at in a frame."""

from __future__ import annotations


def rows(df) -> list[tuple]:
    """Rows as sorted tuples, columns in their own order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
