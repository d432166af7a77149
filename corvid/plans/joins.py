"""Join strategy helpers.

A side is broadcast only after its size has been checked; beyond the bound the
caller gets ``None`` back and takes a shuffle join instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bounds on a broadcast side: rows, and bytes as estimated from the
# schema (Spark's per-type default sizes; strings count 20 bytes).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_row_bytes(df: DataFrame) -> int:
    """Spark's schema-based row size estimate (``StructType.defaultSize``)."""
    return max(1, int(df._jdf.schema().defaultSize()))


# A side this small is settled by one incremental ``take`` of a one-value column
# (usually a single stage) instead of a distributed count.
PROBE_ROWS = 10_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame | None:
    """Return ``broadcast(df)`` when ``df`` has at most ``min(max_rows, max_bytes / row
    size)`` rows, else None.

    First a probe brings at most ``PROBE_ROWS + 1`` literal values to the driver; a side
    larger than that is counted (a partial count per task, no rows move).
    """
    bound = min(max_rows, max_bytes // estimated_row_bytes(df))
    if bound <= 0:
        return None
    probe = min(bound, PROBE_ROWS)
    if len(df.select(F.lit(True).alias("_row")).take(probe + 1)) <= probe:
        return F.broadcast(df)
    if probe >= bound or df.count() > bound:
        return None
    return F.broadcast(df)


def checked_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` with ``right`` broadcast if its size has been checked, else a shuffle join.

    Spark's own guess goes by the bytes of the files: a few MB of well compressed rows can be
    hundreds of MB on the driver, more so if a generator or a wide projection stands above them.
    """
    small = broadcast_if_small(right)
    return left.join(small if small is not None else right.hint("merge"), on, how)
