"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest side we hint for broadcast (each executor holds a copy).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (exact for local data, file-size based for scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only for a side whose estimated size is under ``limit``.

    Larger dimensions are left to the planner (shuffle join, or AQE's runtime
    conversion to broadcast once it has measured the side).
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
