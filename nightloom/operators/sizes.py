"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def broadcast_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for a broadcast if it has at most so many rows, which is counted no further than that; else df as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
