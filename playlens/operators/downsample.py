"""Down-sampling of interaction tables by item popularity, at random, or to a user set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.broadcast import bounded_broadcast
from playlens.functions.keys import seeded_unit, with_hash_ids
from playlens.functions.lineage import kept
from playlens.functions.skew import LEAST_ROWS, heavy_bound
from playlens.operators.stats import item_totals, running_share

REPEAT_CHUNK = 65536  # copies generated per array in the fan-out repeat
HOT_CHUNK = 1024  # the same for users with very many copies: what is dealt to tasks


def items_by_share(df: DataFrame, cutoff: float, item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """Per-item totals with their running row share (RANGE peers), keeping share <= cutoff."""
    shares = running_share(item_totals(df, item_col, count_col), "row_totals", "row_running_pct")
    return shares.filter(F.col("row_running_pct") <= F.lit(float(cutoff)))


def downsample_by_share(df: DataFrame, cutoff: float, item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """Rows of the head items: those whose running share of rows, most frequent first, is <= cutoff.

    The row total is computed in the same job (no literal). The kept-item list can be as large as
    the item table, so it is joined without a hint: AQE broadcasts it when the measured list is
    small and otherwise splits a hot item's partition (skew join) in the shuffle join.
    """
    keep = items_by_share(df, cutoff, item_col, count_col).select(item_col)
    return df.join(keep, item_col, "left_semi").select(*df.columns)


def top_items_by_rows(df: DataFrame, n: int, item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """The ``n`` items with most rows; ties by item id (the reference's bare LIMIT is arbitrary)."""
    return item_totals(df, item_col, count_col).orderBy(F.col("row_totals").desc(), F.col(item_col).asc()).limit(n)


def downsample_top_n(df: DataFrame, n: int, item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """Rows of the ``n`` most frequent items. The list has at most n rows, so it may be broadcast."""
    keep = bounded_broadcast(top_items_by_rows(df, n, item_col, count_col).select(item_col), n)
    return df.join(keep, item_col, "left_semi").select(*df.columns)


def sample_items(df: DataFrame, fraction: float, seed: int = 0, item_col: str = "track_id",
                 repeatable: bool = True) -> DataFrame:
    """Distinct items kept with probability ``fraction``.

    ``repeatable=True`` keeps an item when its seeded hash, as a share of the full hash range, is
    below ``fraction``: the same items for the same seed on any cluster, for keys of any type. ``repeatable=False`` is
    ``DataFrame.sample`` (Bernoulli per row, depends on partitioning).
    """
    items = df.select(item_col).distinct()
    if not repeatable:
        return items.sample(fraction=fraction, seed=seed)
    return items.filter(seeded_unit(item_col, seed) < F.lit(float(fraction)))


def downsample_random_items(df: DataFrame, fraction: float, seed: int = 0, item_col: str = "track_id") -> DataFrame:
    """Rows of a random item subset. The same predicate filters the rows directly, so no
    join is needed: each row's item decides for itself."""
    return df.filter(seeded_unit(item_col, seed) < F.lit(float(fraction)))


def restrict_to_users(train: DataFrame, val: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Train rows of users who appear in ``val`` (left semi join), with hash ids added."""
    users = val.select(user_col).distinct()
    return with_hash_ids(train.join(users, user_col, "left_semi").select(*train.columns), user_col)


def repeated_row_counts(train: DataFrame, val: DataFrame, user_col: str = "user_id") -> DataFrame:
    """One row: how many rows and users ``restrict_to_users_repeated`` has, without making the rows."""
    ours = train.groupBy(user_col).agg(F.count("*").alias("_t"))
    theirs = val.groupBy(user_col).agg(F.count("*").alias("_v"))
    return ours.join(theirs, user_col).agg(
        F.coalesce(F.sum(F.col("_t") * F.col("_v")), F.lit(0)).cast("bigint").alias("n_rows"), F.count("*").alias("n_users"))


def restrict_to_users_repeated(train: DataFrame, val: DataFrame, user_col: str = "user_id", least_rows: int = LEAST_ROWS) -> DataFrame:
    """Inner-join semantics of train x val on the user: each train row once per val row of its user.

    Instead of a many-to-many join, val is reduced to one count per user, joined (one partner
    row per key), and each train row is repeated by that count. Users with very many copies are found
    from the counts first: their rows are not shuffled to one task by user, and their copies are dealt by
    (row, chunk of copies) before they are made.
    """
    ours = train.groupBy(user_col).agg(F.count("*").alias("_t"))
    per_user = kept(ours.join(val.groupBy(user_col).agg(F.count("*").alias("_n")), user_col).select(
        user_col, "_n", (F.col("_t") * F.col("_n")).alias("_w")))
    heavy = heavy_bound(per_user, "_w", least_rows)
    hot = F.broadcast(per_user.where(heavy).select(user_col, "_n"))
    columns = train.columns

    def chunks(joined: DataFrame, size: int) -> DataFrame:
        return joined.select(*columns, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / size))).alias("_c"))

    def copies(parts: DataFrame, size: int) -> DataFrame:
        own = F.least(F.lit(size), F.col("_n") - F.col("_c") * size)
        return parts.select(*columns, F.explode(F.sequence(F.lit(1), own.cast("long"))).alias("_copy")).drop("_copy")

    # Repeat in two levels, so no generated array grows with a heavy user's validation count.
    rest = train.join(F.broadcast(per_user.where(heavy).select(user_col)), user_col, "left_anti")
    plain = copies(chunks(rest.join(per_user.where(~heavy).select(user_col, "_n"), user_col), REPEAT_CHUNK), REPEAT_CHUNK)
    tasks = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks(train.join(hot, user_col), HOT_CHUNK).repartition(tasks, F.xxhash64(*columns, "_c"))
    return plain.unionByName(copies(dealt, HOT_CHUNK))
