"""Joins with heavy keys: rows of frequent keys stay where they are, only their partner rows travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HEAVY = 10_000  # keys that can have more than 1 / MAX_HEAVY of all rows
LEAST_ROWS = 100_000  # below this many rows a key is not heavy


def heavy_bound(weights: DataFrame, weight: str, least_rows: int = LEAST_ROWS) -> Column:
    """Whether a key's weight is over the larger of ``least_rows`` and a MAX_HEAVY-th of the whole.

    At most MAX_HEAVY keys can be, whatever the data, so their rows may be broadcast.
    """
    whole = weights.agg(F.coalesce(F.sum(weight), F.lit(0))).scalar()
    return F.col(weight) > F.greatest(F.lit(least_rows), whole / MAX_HEAVY)


def join_unique(left: DataFrame, right: DataFrame, key: str, weight: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row per key, with ``weight`` = the key's rows in ``left``.

    Left rows of heavy keys meet a broadcast of those keys' right rows (MAX_HEAVY at most) and are not
    shuffled; the others are joined by shuffle.
    """
    heavy = heavy_bound(right, weight, least_rows)
    few = F.broadcast(right.where(heavy))
    hot = left.join(few, key)
    return hot.unionByName(left.join(F.broadcast(right.where(heavy).select(key)), key, "left_anti").join(right.where(~heavy), key))
