"""Size checks behind every hand-made broadcast.

A side is broadcast only when the optimizer's size estimate of its plan is
under a bound; otherwise the join is left to the planner (sort-merge, with AQE
free to switch to a broadcast at runtime once real sizes are known).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Files unpack to several times their size; the bound on the estimate allows for that.
UNPACKED = 4
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024 // UNPACKED


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan, in bytes.

    For files this is the compressed size, which is below the size in memory; see ``UNPACKED``.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(str(size.toString()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side whose estimated size is within ``max_bytes``."""
    if estimated_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df


def parts_for(df: DataFrame, bytes_per_part: int) -> int:
    """Number of parts so that each holds about ``bytes_per_part`` of the (compressed) input.

    Sets only how the work is laid out; results don't depend on it.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    estimate = estimated_bytes(df)
    if estimate > 1 << 60:  # an unknown size
        estimate = 0
    return max(least, math.ceil(estimate / bytes_per_part))
