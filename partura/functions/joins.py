"""Joining facts with dimensions of checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.rules import Rules


def _estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where the plan is not reachable from Python."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, rules: Rules) -> DataFrame:
    """Hint a broadcast only when the size is proven; else leave a shuffle join, split by AQE.

    The plan estimate is free. Where it is too coarse (a join's estimate is the product of its
    sides) one job counts the rows, each task its own.
    """
    size = _estimated_bytes(df)
    if size is not None and size <= rules.broadcast_bytes:
        return F.broadcast(df)
    if df.count() <= rules.broadcast_rows:
        return F.broadcast(df)
    return df
