"""Size-checked broadcast.

A side is broadcast only after a cheap bounded count proves it holds at most
``max_rows`` rows; otherwise the join is left to the planner (AQE can still
turn it into a broadcast from measured shuffle sizes, or split skewed
partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000


def at_most(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads at most one more."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """``broadcast(df)`` when a bound proven elsewhere says it is small."""
    return F.broadcast(df) if small else df


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df``.

    The count reads at most ``max_rows + 1`` rows, so the check itself is
    bounded whatever the table size."""
    return broadcast_if(df, at_most(df, max_rows))
