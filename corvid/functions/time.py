"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00:00 as BIGINT.

    The value is taken as wall-clock UTC (``timestamp_ntz``), which is what the
    parquet files hold, so the result is the same under every session time zone.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"),
                            col.cast("timestamp_ntz"))
