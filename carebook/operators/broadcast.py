"""Broadcast only what has a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows of a dimension table (a
    closed list such as districts or areas). Past the bound the side is left
    unhinted and Spark plans a shuffle join, or AQE re-plans it at runtime from
    real sizes; a grown dimension then costs speed, never a driver or executor
    out of memory.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
