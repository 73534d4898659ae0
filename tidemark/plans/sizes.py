"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of a join is broadcast if it was counted and has at most this many rows.
SMALL = 100_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; else as it is, for the optimizer to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
