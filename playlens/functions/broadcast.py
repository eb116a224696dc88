"""Broadcast only what has a size bound.

``bounded_broadcast`` is for sides whose row count is bounded by a parameter or by arithmetic
(a top-N list, a histogram of counts, one row per partition). Data-dependent sides are joined
without a hint: AQE measures the finished shuffle and turns the join into a broadcast join only
when the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.

``never_broadcast`` is for data-dependent sides whose size Spark estimates too low before it runs: the
bytes of compressed files, which an explode or wider rows multiply without Spark counting it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many rows a bounded side is still joined by shuffle.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when ``max_rows`` (a proven upper bound on ``df``'s rows) is small enough."""
    return F.broadcast(df) if max_rows <= MAX_BROADCAST_ROWS else df


def never_broadcast(df: DataFrame) -> DataFrame:
    """Hint a sort-merge join, whatever size Spark estimates or AQE measures for either side."""
    return df.hint("merge")
