"""Integer keys for ALS and joins: Spark's 32-bit hash ids, their collision audit, dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_id(col: str | Column) -> Column:
    """Spark ``hash`` (Murmur3 x86 32-bit, seed 42) as the integer id ALS needs.

    The hash of a BIGINT, an INT and a STRING with the same digits differ, so a key column must keep
    one type everywhere it is hashed. BIGINT keys in [0, 2^32) never collide (with the high word 0,
    every Murmur3 step is invertible on 32 bits); string keys collide at the birthday rate,
    about n^2 / 2^33 pairs for n keys, which ``hash_audit`` counts.
    """
    return F.hash(F.col(col) if isinstance(col, str) else col)


def seeded_unit(col: str | Column, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) for a key of any type: the full 32-bit range of ``hash(seed, key)``.

    The seed is hashed first, so other seeds give unrelated numbers; ids that share low digits do not
    share a number. A null key gets the seed's own number.
    """
    key = F.col(col) if isinstance(col, str) else col
    return (F.hash(F.lit(seed).cast("bigint"), key).cast("bigint") + F.lit(2**31)) / F.lit(float(2**32))


def with_hash_ids(df: DataFrame, user_col: str = "user_id", item_col: str = "track_id") -> DataFrame:
    """Add ``user_hashId`` and ``track_hashId`` next to the original keys."""
    return df.withColumn("user_hashId", hash_id(user_col)).withColumn("track_hashId", hash_id(item_col))


def item_dictionary(df: DataFrame, item_col: str = "track_id", out_col: str = "item_hashId") -> DataFrame:
    """Distinct items with their hash id (the item dictionary H)."""
    return df.select(item_col).distinct().withColumn(out_col, hash_id(item_col))


def dense_ids(df: DataFrame, id_col: str, out_col: str = "dense_id") -> DataFrame:
    """Distinct ids numbered 1..n in id order: a collision-free alternative to hash ids.

    Same values as ``dense_rank() OVER (ORDER BY id)``, computed by ``positions`` (range sort, per
    task numbering, partition offsets) instead of a window that puts every id in one task.
    """
    from playlens.functions.positions import positions

    return positions(df.select(id_col).distinct(), [F.col(id_col).asc()], name=out_col)


def hash_audit(ids: DataFrame, id_col: str, hash_col: str | None = None) -> DataFrame:
    """One row: distinct ids, distinct hashes, hashes shared by more than one id, ids involved.

    One aggregation by hash value: Spark dedupes (hash, id) map-side before the shuffle, so a key
    repeated in a third of all rows costs one row per task, not one task.
    """
    h = F.col(hash_col) if hash_col else hash_id(id_col)
    per_hash = ids.select(h.alias("_h"), F.col(id_col).alias("_id")).groupBy("_h").agg(
        F.countDistinct("_id").alias("_ids")
    )
    return per_hash.agg(
        F.sum("_ids").cast("bigint").alias("n_ids"),
        F.count("*").alias("n_hashes"),
        F.count(F.when(F.col("_ids") > 1, 1)).alias("n_colliding_hashes"),
        F.coalesce(F.sum(F.when(F.col("_ids") > 1, F.col("_ids"))), F.lit(0)).cast("bigint").alias("n_colliding_ids"),
    )


def hash_collisions(ids: DataFrame, id_col: str) -> DataFrame:
    """Offending hash values with the ids that share them (one row per (hash, id))."""
    pairs = ids.select(hash_id(id_col).alias("hash_id"), F.col(id_col)).distinct()
    shared = pairs.groupBy("hash_id").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("hash_id")
    return pairs.join(shared, "hash_id", "left_semi")
