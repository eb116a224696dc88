"""Exact ``row_number()`` without putting a whole group, or the whole table, in one task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task, and a window without
``partitionBy`` sends the whole table to one task. Here the rows are range-partitioned on
(g, o) instead, so a group holding a third of all rows is spread over many tasks:

1. ``repartitionByRange`` + ``sortWithinPartitions`` on (group, order); tag each row with
   ``monotonically_increasing_id`` (partition id in the high bits, index in the partition below).
2. Checkpoint, so the tags stay fixed when a task or an executor is lost and rerun.
3. Per (partition, group): row count and first index. Offsets are the counts of the same group in
   earlier partitions: a window per group over at most one row per partition.
4. position = index - first index of the group in this partition + 1 + offset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition id above bit 33


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def positions(
    df: DataFrame,
    order_by: list[str | Column],
    partition_by: list[str] | tuple[str, ...] = (),
    name: str = "pos",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based ``row_number() OVER (PARTITION BY partition_by ORDER BY order_by)``.

    ``order_by`` must be a total order inside each group (end it with a unique key), otherwise the
    numbering of tied rows is arbitrary, as it is for ``row_number``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    groups = list(partition_by)
    keys = _cols(groups) + _cols(order_by)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    tagged = tagged.withColumn("_pid", F.shiftrightunsigned("_mid", _LOCAL_BITS)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    gcols = ["_pid", *groups]
    counts = tagged.groupBy(*gcols).agg(F.count("*").alias("_n"), F.min("_loc").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*gcols, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    if not groups:
        # One row per partition of the range sort: bounded by the partition count.
        offsets = F.broadcast(offsets)
    t, o = tagged.alias("_t"), offsets.alias("_o")
    cond = reduce(lambda a, b: a & b, [F.col(f"_t.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in gcols])
    return t.join(o, cond).select(
        *[F.col(f"_t.`{c}`") for c in df.columns],
        (F.col("_t._loc") - F.col("_o._first") + 1 + F.col("_o._off")).alias(name),
    )
