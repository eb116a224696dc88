"""Registered queries: table statistics, popularity shares, quantiles, hashing, down-sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playlens.functions import keys
from playlens.operators import downsample, stats
from playlens.plans.oracle import murmur3_bigint, seeded_unit_bigint, with_fixtures
from playlens.plans.registry import query
from playlens.session import ensure_checkpoint_dir
from playlens.sources import fixtures as fx
from playlens.sources import sinks
from playlens.sources.sinks import write_csv
from playlens.sources.tables import ITEM_USAGE_BIGINT, read_parquet_dir, read_usage_csv

# Fixed values of the evaluated jobs: share cutoff, nominal size, random sample, listener thresholds.
SHARE_CUTOFF = 0.5      # head items holding half of the rows
TOP_N_ITEMS = 500       # nominal down-sampling size
SAMPLE_FRACTION = 0.5   # random item sample, seed 0
SAMPLE_SEED = 0
AT_MOST_MAX = 14        # share of items with at most i listeners, i = 1..14

USAGE_SQL = "SELECT track_id, COUNT(user_id) AS unique_plays, CAST(SUM(count) AS BIGINT) AS total_plays FROM train GROUP BY track_id"
TOTALS_SQL = "SELECT track_id, CAST(SUM(count) AS BIGINT) AS play_counts, COUNT(*) AS row_totals FROM train GROUP BY track_id"
RUNNING_SQL = f"""SELECT track_id, play_counts, row_totals,
        CAST(SUM(row_totals) OVER (ORDER BY row_totals DESC) AS DOUBLE) / SUM(row_totals) OVER () AS row_running_pct
    FROM ({TOTALS_SQL}) t"""
CUM_ROWS_SQL = f"""SELECT track_id, unique_plays, total_plays,
        CAST(SUM(unique_plays) OVER (ORDER BY unique_plays DESC, track_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
            / SUM(unique_plays) OVER () AS pct_plays,
        ROW_NUMBER() OVER (ORDER BY unique_plays DESC, track_id) AS rank
    FROM ({USAGE_SQL}) u"""


def _usage(spark, sf_dir):
    return stats.item_usage(fx.train(spark, sf_dir))


@query("basic_stats", with_fixtures(
    "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT track_id) AS n_items FROM train"))
def basic_stats(spark, sf_dir):
    return stats.basic_stats(fx.train(spark, sf_dir))


@query("item_totals", with_fixtures(TOTALS_SQL))
def item_totals(spark, sf_dir):
    return stats.item_totals(fx.train(spark, sf_dir))


@query("item_usage", with_fixtures(USAGE_SQL))
def item_usage(spark, sf_dir):
    return _usage(spark, sf_dir)


@query("csv_roundtrip", with_fixtures(USAGE_SQL))
def csv_roundtrip(spark, sf_dir):
    """Item usage written as headerless CSV to the shared checkpoint folder and read back by schema."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/item_usage_csv/{uuid.uuid4().hex}"
    _usage(spark, sf_dir).orderBy(F.col("unique_plays").desc(), "track_id").write.mode("overwrite").csv(path)
    return read_usage_csv(spark, path, ITEM_USAGE_BIGINT)


@query("csv_roundtrip_strings", with_fixtures(f"""
    SELECT 'TR' || track_id AS track_id, unique_plays, total_plays FROM ({USAGE_SQL}) u"""))
def csv_roundtrip_strings(spark, sf_dir):
    """The same with string item ids, the readers' default."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/item_usage_csv/{uuid.uuid4().hex}"
    usage = _usage(spark, sf_dir).withColumn("track_id", F.concat(F.lit("TR"), F.col("track_id").cast("string")))
    write_csv(usage, path)
    return read_usage_csv(spark, path)


def _scratch_path(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


@query("parquet_dir_roundtrip", with_fixtures(USAGE_SQL))
def parquet_dir_roundtrip(spark, sf_dir):
    """Item usage written as Parquet by many tasks and read back as one table of many files."""
    path = _scratch_path(spark, "item_usage")
    sinks.write_parquet(_usage(spark, sf_dir).repartition(4, "track_id"), path)
    return read_parquet_dir(spark, path)


@query("sized_slices_roundtrip", with_fixtures(USAGE_SQL))
def sized_slices_roundtrip(spark, sf_dir):
    """The same in as many files of 64 KiB as its measured size asks for."""
    path = _scratch_path(spark, "item_usage")
    sinks.write_sized(_usage(spark, sf_dir), path, 64 << 10)
    return read_parquet_dir(spark, path)


@query("partitioned_roundtrip", with_fixtures(f"SELECT *, CAST(total_plays % 4 AS INTEGER) AS part FROM ({USAGE_SQL}) u"))
def partitioned_roundtrip(spark, sf_dir):
    """The same with a folder per value of a column."""
    path = _scratch_path(spark, "item_usage")
    sinks.write_partitioned(_usage(spark, sf_dir).withColumn("part", (F.col("total_plays") % 4).cast("int")), path, "part")
    return read_parquet_dir(spark, path)


@query("downsample_random_other_seed", with_fixtures(f"""
    SELECT user_id, count, track_id FROM train
    WHERE {seeded_unit_bigint('track_id', SAMPLE_SEED + 1)} < {SAMPLE_FRACTION}"""))
def downsample_random_other_seed(spark, sf_dir):
    return downsample.downsample_random_items(fx.train(spark, sf_dir), SAMPLE_FRACTION, SAMPLE_SEED + 1).select(
        "user_id", "count", "track_id")


@query("distinct_items", with_fixtures("SELECT DISTINCT track_id FROM train"))
def distinct_items(spark, sf_dir):
    return stats.distinct_items(fx.train(spark, sf_dir))


@query("item_hash", with_fixtures(f"SELECT track_id, {murmur3_bigint('track_id')} AS item_hashId FROM (SELECT DISTINCT track_id FROM train) t"))
def item_hash(spark, sf_dir):
    return keys.item_dictionary(fx.train(spark, sf_dir))


@query("hash_audit", with_fixtures(f"""
    SELECT CAST(SUM(n) AS BIGINT) AS n_ids, COUNT(*) AS n_hashes, COUNT(*) FILTER (WHERE n > 1) AS n_colliding_hashes,
           CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_colliding_ids
    FROM (SELECT h, COUNT(DISTINCT user_id) AS n FROM (SELECT user_id, {murmur3_bigint('user_id')} AS h FROM
          (SELECT DISTINCT user_id FROM interactions) d) x GROUP BY h) y"""))
def hash_audit(spark, sf_dir):
    return keys.hash_audit(fx.interactions(spark, sf_dir).select("user_id"), "user_id")


@query("column_nunique", with_fixtures("""
    SELECT COUNT(DISTINCT tid_key) AS n_tid_key, COUNT(DISTINCT tag_key) AS n_tag_key, COUNT(DISTINCT val) AS n_val
    FROM tid_tag"""))
def column_nunique(spark, sf_dir):
    return stats.column_nunique(fx.tid_tag(spark, sf_dir))


@query("play_deciles", with_fixtures(f"""
    SELECT CAST(g.i AS DOUBLE) / 10 AS p, ROUND(q.qs[g.i], 6) AS unique_plays
    FROM (SELECT quantile_cont(unique_plays, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS qs
          FROM ({USAGE_SQL}) u) q, range(1, 11) g(i)"""))
def play_deciles(spark, sf_dir):
    return stats.quantiles(_usage(spark, sf_dir), "unique_plays", [i / 10 for i in range(1, 11)], "unique_plays")


@query("duration_quartiles", with_fixtures("""
    SELECT CAST(g.i AS DOUBLE) / 4 AS p, ROUND(q.qs[g.i], 6) AS duration
    FROM (SELECT quantile_cont(duration, [0.25, 0.5, 0.75]) AS qs FROM songs) q, range(1, 4) g(i)"""))
def duration_quartiles(spark, sf_dir):
    return stats.quantiles(fx.songs(spark, sf_dir), "duration", [0.25, 0.5, 0.75], "duration")


QUARTILE_SQL = """
    SELECT track_id, CASE WHEN duration >= q[3] THEN 1 WHEN duration >= q[2] AND duration < q[3] THEN 2
                          WHEN duration >= q[1] AND duration < q[2] THEN 3 WHEN duration < q[1] THEN 4 END AS quartile
    FROM songs, (SELECT quantile_cont(duration, [0.25, 0.5, 0.75]) AS q FROM songs) qq"""


@query("duration_quartile", with_fixtures(QUARTILE_SQL))
def duration_quartile(spark, sf_dir):
    return stats.quartile_band(fx.songs(spark, sf_dir), "duration", "quartile").select("track_id", "quartile")


@query("quartile_counts", with_fixtures(f"""
    SELECT quartile, COUNT(*) AS n_rows, SUM(COUNT(*)) OVER () AS n_total FROM ({QUARTILE_SQL}) b GROUP BY quartile""",
))
def quartile_counts(spark, sf_dir):
    return stats.band_counts(stats.quartile_band(fx.songs(spark, sf_dir)), "quartile").select(
        "quartile", "n_rows", F.col("n_total").cast("bigint").alias("n_total"))


@query("running_share", with_fixtures(f"SELECT track_id, play_counts, row_totals, ROUND(row_running_pct, 6) AS row_running_pct FROM ({RUNNING_SQL}) r"))
def running_share(spark, sf_dir):
    out = stats.running_share(stats.item_totals(fx.train(spark, sf_dir)))
    return out.select("track_id", "play_counts", "row_totals", F.round("row_running_pct", 6).alias("row_running_pct"))


@query("cum_share_rows", with_fixtures(f"SELECT track_id, unique_plays, total_plays, ROUND(pct_plays, 6) AS pct_plays FROM ({CUM_ROWS_SQL}) c"))
def cum_share_rows(spark, sf_dir):
    out = stats.cumulative_share_rows(_usage(spark, sf_dir))
    return out.withColumn("pct_plays", F.round("pct_plays", 6))


@query("long_tail_curve", with_fixtures(f"SELECT CAST(rank AS BIGINT) AS rank, track_id, unique_plays, ROUND(pct_plays, 6) AS pct_plays FROM ({CUM_ROWS_SQL}) c"))
def long_tail_curve(spark, sf_dir):
    out = stats.cumulative_share_rows(_usage(spark, sf_dir), rank_col="rank")
    return out.select("rank", "track_id", "unique_plays", F.round("pct_plays", 6).alias("pct_plays"))


@query("decile_cutoffs", with_fixtures(f"""
    SELECT CAST(g.i AS DOUBLE) / 10 AS p, (SELECT COUNT(*) FROM ({CUM_ROWS_SQL}) c WHERE c.pct_plays <= CAST(g.i AS DOUBLE) / 10) AS n_items
    FROM range(1, 11) g(i)"""))
def decile_cutoffs(spark, sf_dir):
    return stats.share_thresholds(stats.cumulative_share_rows(_usage(spark, sf_dir)), "pct_plays", 10, "n_items")


@query("share_at_most", with_fixtures(f"""
    SELECT g.i AS max_plays, ROUND(CAST((SELECT COUNT(*) FROM ({USAGE_SQL}) u WHERE u.unique_plays <= g.i) AS DOUBLE)
                                   / (SELECT COUNT(*) FROM ({USAGE_SQL}) u2), 6) AS share
    FROM range(1, {AT_MOST_MAX + 1}) g(i)"""))
def share_at_most(spark, sf_dir):
    return stats.share_at_most(_usage(spark, sf_dir), "unique_plays", AT_MOST_MAX)


@query("downsample_share", with_fixtures(f"""
    SELECT t.user_id, t.count, t.track_id FROM train t
    JOIN ({RUNNING_SQL}) r ON t.track_id = r.track_id WHERE r.row_running_pct <= {SHARE_CUTOFF}"""))
def downsample_share(spark, sf_dir):
    return downsample.downsample_by_share(fx.train(spark, sf_dir), SHARE_CUTOFF).select("user_id", "count", "track_id")


@query("downsample_top_n", with_fixtures(f"""
    SELECT t.user_id, t.count, t.track_id FROM train t
    JOIN (SELECT track_id FROM ({TOTALS_SQL}) x ORDER BY row_totals DESC, track_id LIMIT {TOP_N_ITEMS}) s
      ON t.track_id = s.track_id"""))
def downsample_top_n(spark, sf_dir):
    return downsample.downsample_top_n(fx.train(spark, sf_dir), TOP_N_ITEMS).select("user_id", "count", "track_id")


@query("downsample_random", with_fixtures(f"""
    SELECT user_id, count, track_id FROM train
    WHERE {seeded_unit_bigint('track_id', SAMPLE_SEED)} < {SAMPLE_FRACTION}"""))
def downsample_random(spark, sf_dir):
    return downsample.downsample_random_items(fx.train(spark, sf_dir), SAMPLE_FRACTION, SAMPLE_SEED).select(
        "user_id", "count", "track_id")


@query("train_users_in_val", with_fixtures(f"""
    SELECT user_id, track_id, count, {murmur3_bigint('user_id')} AS user_hashId, {murmur3_bigint('track_id')} AS track_hashId
    FROM train WHERE user_id IN (SELECT user_id FROM val)"""))
def train_users_in_val(spark, sf_dir):
    return downsample.restrict_to_users(fx.train(spark, sf_dir), fx.val(spark, sf_dir))


@query("train_users_in_val_inner", with_fixtures("""
    SELECT t.user_id, t.track_id, t.count FROM train t INNER JOIN val v ON t.user_id = v.user_id"""))
def train_users_in_val_inner(spark, sf_dir):
    return downsample.restrict_to_users_repeated(fx.train(spark, sf_dir), fx.val(spark, sf_dir))


@query("users_in_val_count", with_fixtures("""
    SELECT COUNT(*) AS n_rows, COUNT(DISTINCT t.user_id) AS n_users FROM train t INNER JOIN val v ON t.user_id = v.user_id"""))
def users_in_val_count(spark, sf_dir):
    return downsample.repeated_row_counts(fx.train(spark, sf_dir), fx.val(spark, sf_dir))


@query("item_dense_ids", with_fixtures(
    "SELECT track_id, CAST(DENSE_RANK() OVER (ORDER BY track_id) AS BIGINT) AS dense_id FROM (SELECT DISTINCT track_id FROM train) t"))
def item_dense_ids(spark, sf_dir):
    return keys.dense_ids(fx.train(spark, sf_dir), "track_id")


@query("downsample_random_sizes", with_fixtures(f"""
    SELECT (SELECT COUNT(*) FROM train) AS n_rows_before, COUNT(*) AS n_rows_after,
           (SELECT COUNT(DISTINCT track_id) FROM train) AS n_items_before, COUNT(DISTINCT track_id) AS n_items_after
    FROM train
    WHERE {seeded_unit_bigint('track_id', SAMPLE_SEED)} < {SAMPLE_FRACTION}"""))
def downsample_random_sizes(spark, sf_dir):
    """Rows and items before and after the random item sample (one aggregate each side)."""
    train = fx.train(spark, sf_dir)
    after = downsample.downsample_random_items(train, SAMPLE_FRACTION, SAMPLE_SEED)
    before = train.agg(F.count("*").alias("n_rows_before"), F.countDistinct("track_id").alias("n_items_before"))
    kept = after.agg(F.count("*").alias("n_rows_after"), F.countDistinct("track_id").alias("n_items_after"))
    return kept.select("n_rows_after", "n_items_after",
                       before.select("n_rows_before").scalar().alias("n_rows_before"),
                       before.select("n_items_before").scalar().alias("n_items_before"))


@query("downsample_share_sizes", with_fixtures(f"""
    SELECT COUNT(*) AS n_items_kept, CAST(SUM(row_totals) AS BIGINT) AS n_rows_kept
    FROM ({RUNNING_SQL}) r WHERE row_running_pct <= {SHARE_CUTOFF}"""))
def downsample_share_sizes(spark, sf_dir):
    """Items kept by the share cutoff and the rows they carry (no second pass over the rows)."""
    kept = downsample.items_by_share(fx.train(spark, sf_dir), SHARE_CUTOFF)
    return kept.agg(F.count("*").alias("n_items_kept"), F.sum("row_totals").cast("bigint").alias("n_rows_kept"))
