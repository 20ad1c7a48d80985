"""Size checks that guard every broadcast.

A side is broadcast only when its size is proven small: either bounded by a
parameter (dimension count, centroid count, a tool registry) or measured by
counting its rows before the join. Beyond the bound the caller falls back to
a shuffled join (with AQE skew handling on).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a data-dependent side is not broadcast. 2M narrow rows
# (a few tens of bytes each) stay well under the default 8 GB broadcast cap and
# a typical executor's storage memory.
MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       keep_first: bool = True) -> tuple[DataFrame, bool]:
    """Return (df with a broadcast hint if it has at most `max_rows` rows, hinted?).

    `keep_first=True` (for sides that are costly to compute, e.g. search
    hits): the side is kept (memory and disk) and counted, so it is computed
    once whatever the outcome. `keep_first=False` (for sides that are cheap to
    recompute but may be large): a bounded count (`limit(max_rows + 1)`,
    every partition stops at the bound) decides first, and only a side under
    the bound is kept for the broadcast.
    """
    if keep_first:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        n = df.count()
        return (F.broadcast(df), True) if n <= max_rows else (df, False)
    n = df.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(df.persist(StorageLevel.MEMORY_AND_DISK)), True
    return df, False
