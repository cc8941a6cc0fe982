"""Broadcast only behind a size check.

``F.broadcast`` forces a broadcast regardless of size, which is how a "small"
dimension turns into a driver OOM at scale. :func:`broadcast_if_small` reads
Catalyst's optimized-plan size estimate (no job is run), scales it for decoding,
and hints a broadcast only below a bound; above it the join is left to sort-merge and AQE, which
re-plans from runtime shuffle statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Fixed value: assumed growth of Catalyst's estimate once built into an in-memory hash
# relation. Scan estimates are compressed on-disk bytes (columnar pages decode to several
# times their size), so the bound is checked against estimate × EXPANSION.
EXPANSION = 5


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for ``df`` (an upper bound for scans/projections), or None."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        # Py4J returns a Scala BigInt as a Python int; older gateways hand back the object
        return size if isinstance(size, int) else int(str(size.toString()))
    except Exception:  # pragma: no cover - e.g. Spark Connect has no JVM handle
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the expanded size estimate is within ``max_bytes``."""
    est = estimated_bytes(df)
    if est is not None and est * EXPANSION <= max_bytes:
        return F.broadcast(df)
    return df
