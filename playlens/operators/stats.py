"""Interaction statistics: counts, per-item totals, popularity shares, quantiles, long tail.

Running shares over items sorted by popularity never use a window over the whole item table.
They go through the *count histogram* (one row per distinct count value). Counts that add up to N
rows take at most sqrt(2N) distinct values: about 1.4 million for 10^12 interaction rows. So the
histogram is small enough to window over in one task and to broadcast back to the items.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.positions import positions
from playlens.session import ensure_checkpoint_dir


def basic_stats(df: DataFrame, user_col: str = "user_id", item_col: str = "track_id", approx: bool = False) -> DataFrame:
    """One row: interaction rows, distinct users, distinct items (one job instead of three).

    ``approx=True`` uses HyperLogLog++ sketches (no shuffle of the key sets).
    """
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(
        F.count("*").alias("n_rows"),
        distinct(user_col).alias("n_users"),
        distinct(item_col).alias("n_items"),
    )


def item_totals(df: DataFrame, item_col: str = "track_id", count_col: str = "count") -> DataFrame:
    """Per item: summed play count and number of interaction rows (partial aggregation map-side)."""
    return df.groupBy(item_col).agg(
        F.sum(count_col).cast("bigint").alias("play_counts"), F.count("*").alias("row_totals")
    )


def item_usage(df: DataFrame, item_col: str = "track_id", user_col: str = "user_id", count_col: str = "count") -> DataFrame:
    """Per item: listeners (non-null user rows) and total plays: the item usage table."""
    return df.groupBy(item_col).agg(
        F.count(user_col).alias("unique_plays"), F.sum(count_col).cast("bigint").alias("total_plays")
    )


def distinct_items(df: DataFrame, item_col: str = "track_id") -> DataFrame:
    return df.select(item_col).distinct()


def column_nunique(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row with the distinct count of every column (``n_<column>``)."""
    cols = cols or df.columns
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in cols])


def count_histogram(df: DataFrame, value_col: str) -> DataFrame:
    """(value, n_keys, value_sum): how many keys have each count value. At most sqrt(2N) rows."""
    return df.groupBy(value_col).agg(
        F.count("*").alias("n_keys"), F.sum(value_col).cast("bigint").alias("value_sum")
    )


def _histogram_prefix(df: DataFrame, value_col: str) -> DataFrame:
    """Histogram with, per value v (descending): rows of all values > v, keys with values > v, total."""
    hist = count_histogram(df, value_col)
    desc = Window.orderBy(F.col(value_col).desc())
    before = desc.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    return hist.select(
        value_col,
        "n_keys",
        "value_sum",
        F.coalesce(F.sum("value_sum").over(before), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("n_keys").over(before), F.lit(0)).alias("keys_before"),
        F.sum("value_sum").over(whole).alias("value_total"),
    )


def running_share(totals: DataFrame, value_col: str = "row_totals", out_col: str = "row_running_pct") -> DataFrame:
    """Running share of ``value_col`` in descending order with RANGE peers.

    Same result as ``sum(v) OVER (ORDER BY v DESC) / sum(v)``: tied items share one running total.
    ``totals`` is read twice (histogram and join). Column pruning makes the two branches differ, so
    Spark would aggregate the facts twice. The per-item table is checkpointed once instead; it is
    item-sized, not fact-sized.
    """
    ensure_checkpoint_dir(totals.sparkSession)
    totals = totals.checkpoint(eager=True)
    hist = _histogram_prefix(totals, value_col).select(
        value_col, ((F.col("sum_before") + F.col("value_sum")) / F.col("value_total")).alias(out_col)
    )
    # Broadcast is safe: one row per distinct count value, at most sqrt(2N) rows.
    return totals.join(F.broadcast(hist), value_col)


def cumulative_share_rows(
    usage: DataFrame, value_col: str = "unique_plays", item_col: str = "track_id",
    share_col: str = "pct_plays", rank_col: str | None = None,
) -> DataFrame:
    """Row-wise cumulative share in (value desc, item asc) order, plus the item's rank if asked.

    cum(item) = rows of all larger values + value x position inside its tie group, where the
    position comes from the global rank and the histogram prefix. The global rank is exact and
    never puts a tie group (the many items with one listener) in a single task.
    """
    ranked = positions(usage, [F.col(value_col).desc(), F.col(item_col).asc()], name="_rank")
    # From the ranked (checkpointed) rows, so the usage table is not recomputed from the facts.
    hist = _histogram_prefix(ranked.select(value_col), value_col)
    out = ranked.join(F.broadcast(hist), value_col)  # bounded: sqrt(2N) rows
    cum = F.col("sum_before") + F.col(value_col) * (F.col("_rank") - F.col("keys_before"))
    cols = [F.col(c) for c in usage.columns] + [(cum / F.col("value_total")).alias(share_col)]
    if rank_col:
        cols.append(F.col("_rank").alias(rank_col))
    return out.select(*cols)


def share_thresholds(shares: DataFrame, share_col: str, steps: int = 10, out_col: str = "n_items") -> DataFrame:
    """For p = 1/steps .. 1: number of rows with share <= p (decile cutoffs), one pass."""
    aggs = [F.count(F.when(F.col(share_col) <= i / steps, 1)).alias(f"c{i}") for i in range(1, steps + 1)]
    row = shares.agg(*aggs)
    stacked = ", ".join(f"{i}, c{i}" for i in range(1, steps + 1))
    return row.selectExpr(f"stack({steps}, {stacked}) AS (i, {out_col})").select(
        (F.col("i") / steps).alias("p"), F.col(out_col).cast("bigint").alias(out_col)
    )


def share_at_most(usage: DataFrame, value_col: str = "unique_plays", max_value: int = 14) -> DataFrame:
    """For i = 1 .. max_value: share of items with ``value_col`` <= i, one pass."""
    aggs = [F.count(F.when(F.col(value_col) <= i, 1)).alias(f"c{i}") for i in range(1, max_value + 1)]
    row = usage.agg(F.count("*").alias("_n"), *aggs)
    stacked = ", ".join(f"{i}, c{i}" for i in range(1, max_value + 1))
    return row.selectExpr(f"stack({max_value}, {stacked}) AS (i, c)", "_n").select(
        F.col("i").cast("bigint").alias("max_plays"), F.round(F.col("c") / F.col("_n"), 6).alias("share")
    )


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float]) -> DataFrame:
    """One row ``_q``: the interpolated quantiles of the values that are not null (nulls if there are none).

    Values are numbered by ``positions`` (range sort, so no task holds them all); only the rows at the two
    ranks around each quantile are read back.
    """
    values = df.select(F.col(value_col).cast("double").alias("_v")).where("_v is not null")
    ranked = positions(values, [F.col("_v").asc()], name="_pos")
    n = ranked.count()
    ranks = [p * max(n - 1, 0) for p in probs]
    needed = sorted({f(r) + 1 for r in ranks for f in (math.floor, math.ceil)})
    found = ranked.where(F.col("_pos").isin(needed)).agg(
        *[F.max(F.when(F.col("_pos") == k, F.col("_v"))).alias(f"r{k}") for k in needed])

    def between(r: float) -> Column:
        lo, part = math.floor(r), r - math.floor(r)
        low, high = F.col(f"r{lo + 1}"), F.col(f"r{math.ceil(r) + 1}")
        return low if part == 0 else F.when(low == high, low).otherwise((1 - part) * low + part * high)

    return found.select(F.array(*[between(r) for r in ranks]).alias("_q"))


def quantiles(df: DataFrame, value_col: str, probs: list[float], out_col: str = "value",
              approx_accuracy: int | None = None) -> DataFrame:
    """Quantiles, nulls ignored; one row per p.

    Exact by default, with linear interpolation (NumPy's default), from the two rows around each rank
    of a range sort (``exact_quantiles``). With ``approx_accuracy``, ``percentile_approx`` (a mergeable sketch) returns actual
    values within 1/accuracy rank error.
    """
    probs_col = F.array(*[F.lit(float(p)) for p in probs])
    if approx_accuracy:
        row = df.agg(F.percentile_approx(F.col(value_col), probs_col, approx_accuracy).cast("array<double>").alias("_q"))
    else:
        row = exact_quantiles(df, value_col, probs)
    return row.select(
        F.posexplode(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.col("_q").alias("v")))
    ).select(F.col("col.p").alias("p"), F.round(F.col("col.v"), 6).alias(out_col))


def quantile_column(df: DataFrame, value_col: str, probs: list[float]) -> Column:
    """Scalar-subquery column holding the quantile array (usable on any DataFrame, no join)."""
    return exact_quantiles(df, value_col, probs).scalar()


def quartile_band(df: DataFrame, value_col: str = "duration", out_col: str = "quartile") -> DataFrame:
    """Quartile band by half-open comparisons: 1 = [Q3, inf), 2 = [Q2, Q3), 3 = [Q1, Q2), 4 = below Q1.

    A null value matches no band (null ``out_col``), as in the comparison-based split.
    """
    q = quantile_column(df, value_col, [0.25, 0.5, 0.75])
    v = F.col(value_col)
    band = (
        F.when(v >= q[2], 1)
        .when((v >= q[1]) & (v < q[2]), 2)
        .when((v >= q[0]) & (v < q[1]), 3)
        .when(v < q[0], 4)
    )
    return df.withColumn(out_col, band)


def band_counts(banded: DataFrame, band_col: str = "quartile") -> DataFrame:
    """Rows per band (the null band holds rows no band took) and the total next to each."""
    counts = banded.groupBy(band_col).agg(F.count("*").alias("n_rows"))
    return counts.withColumn("n_total", F.sum("n_rows").over(Window.partitionBy()))
