"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The estimate of a file scan is its (compressed) size on disk; rows in memory
# take several times that, hence a limit well below executor memory.
DEFAULT_BROADCAST_LIMIT = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (None if unavailable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # plan not analysable (e.g. streaming) -> unknown
        return None


def broadcast_if_small(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the estimate is under ``limit_bytes``;
    otherwise leave the plan alone (shuffle join, or AQE converting it at run
    time from the measured shuffle size)."""
    size = estimated_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction (an hour
    spine, a band table, a one-row statistic). Callers state the bound."""
    return F.broadcast(df)
