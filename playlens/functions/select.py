"""Exactly sized seeded samples: the k rows with the least hash, without sorting the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HALF = 16  # bits of the hash refined at a time


def seeded_hash(id_col: str, seed: int) -> Column:
    """``hash(seed, id)`` as a number in [0, 2^32)."""
    return F.hash(F.lit(seed).cast("bigint"), F.col(id_col)).cast("bigint") + F.lit(2**31)


def _cut(counts: DataFrame, k: int) -> tuple[int, int]:
    """(bucket that holds the k-th row, rows in the buckets before it) of (b, c) rows, 2^16 at most."""
    below = 0
    for r in counts.orderBy("b").collect():
        if below + r.c >= k:
            return r.b, below
        below += r.c
    raise ValueError("k is larger than the number of rows")


def least_hashes(df: DataFrame, k: int, id_col: str = "id", seed: int = 0) -> Column:
    """A predicate that holds for exactly ``k`` rows of ``df`` (distinct ids): the least by (hash, id).

    Two histograms of 2^16 buckets, each a partial aggregate, find the k-th hash: its high half first, then
    the low half within that bucket. Ids that share this hash are few; they are cut by id order (a null id
    is first). k at most 0 selects none, k at least the row count all.
    """
    if k <= 0:
        return F.lit(False)
    n = df.count()
    if k >= n:
        return F.lit(True)
    h = seeded_hash(id_col, seed)
    high, low = F.shiftright(h, _HALF), h.bitwiseAND(F.lit((1 << _HALF) - 1))
    hashed = df.select(F.col(id_col).alias("id"), h.alias("h"), high.alias("hi"), low.alias("lo"))
    top, below = _cut(hashed.groupBy(F.col("hi").alias("b")).agg(F.count("*").alias("c")), k)
    inside = hashed.where(F.col("hi") == top)
    bottom, more = _cut(inside.groupBy(F.col("lo").alias("b")).agg(F.count("*").alias("c")), k - below)
    edge = (top << _HALF) | bottom
    left = k - below - more
    ids = inside.where(F.col("lo") == bottom).select("id").orderBy(F.col("id").asc_nulls_first()).limit(left).agg(
        F.max("id").alias("last"), F.count("id").alias("some")).first()
    at_edge = F.col(id_col).isNull() | (F.col(id_col) <= F.lit(ids["last"])) if ids["some"] else F.col(id_col).isNull()
    return (h < edge) | ((h == edge) & at_edge)
