"""Operators on hand-made frames: skewed groups, ties, nulls, collisions, cutoffs, brute-force checks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.functions import keys
from playlens.functions.positions import positions
from playlens.operators import coldstart, downsample, features, recommend, stats


def test_positions_match_row_number_under_skew(spark):
    # One user holds a third of all rows; ties in count are broken by track id.
    rows = [(1, t, t % 7) for t in range(600)] + [(u, t, t % 3) for u in range(2, 200) for t in range(6)]
    df = spark.createDataFrame(rows, "user_id long, track_id long, count long")
    order = [F.col("count").desc(), F.col("track_id").asc()]
    got = positions(df, order, ["user_id"], num_partitions=8)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
    assert got.select("user_id", "track_id", "pos").exceptAll(want.select("user_id", "track_id", "pos")).count() == 0
    assert got.count() == df.count()


def test_global_positions(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(1000)], "id long, v long")
    got = positions(df, [F.col("v").desc(), F.col("id")], num_partitions=6).toPandas()
    want = df.toPandas().sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    want["pos"] = np.arange(1, len(want) + 1)
    merged = got.merge(want, on=["id", "v"], suffixes=("", "_w"))
    assert (merged["pos"] == merged["pos_w"]).all() and len(merged) == 1000


def test_running_share_range_and_rows(spark):
    usage = spark.createDataFrame([(1, 5), (2, 5), (3, 3), (4, 1), (5, 1), (6, 1)], "track_id long, unique_plays long")
    rng = stats.running_share(usage, "unique_plays", "pct").toPandas().set_index("track_id")["pct"]
    assert rng[1] == rng[2] == pytest.approx(10 / 16)  # tied items share one RANGE total
    assert rng[4] == pytest.approx(1.0)
    rows = stats.cumulative_share_rows(usage, rank_col="rank").toPandas().set_index("track_id")
    assert rows.loc[1, "pct_plays"] == pytest.approx(5 / 16) and rows.loc[2, "pct_plays"] == pytest.approx(10 / 16)
    assert rows.loc[6, "pct_plays"] == pytest.approx(1.0) and rows.loc[6, "rank"] == 6


def test_downsample_cutoffs(spark):
    rows = [(u, t, 1) for t in range(1, 6) for u in range(t)]  # item t has t rows
    df = spark.createDataFrame(rows, "user_id long, track_id long, count long")
    assert downsample.downsample_by_share(df, 0.0).count() == 0
    assert downsample.downsample_by_share(df, 1.0).count() == df.count()
    assert downsample.downsample_top_n(df, 2).select("track_id").distinct().count() == 2


def test_fan_out_join_equals_inner_join(spark):
    train = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1), (3, 12, 1)], "user_id long, track_id long, count long")
    val = spark.createDataFrame([(1, 20, 1), (1, 21, 1), (1, 22, 1), (2, 20, 1)], "user_id long, track_id long, count long")
    got = downsample.restrict_to_users_repeated(train, val)
    want = train.alias("t").join(val.alias("v"), "user_id").select("user_id", "t.track_id", "t.count")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    semi = downsample.restrict_to_users(train, val)
    assert sorted(r.user_id for r in semi.collect()) == [1, 1, 2]


def test_hash_ids_and_collision_audit(spark):
    df = spark.createDataFrame([(0,), (4,), (-3,), (4,)], "track_id long")
    got = {r.track_id: r.item_hashId for r in keys.item_dictionary(df).collect()}
    assert got == {0: -1670924195, 4: 1344313940, -3: -925101593}
    # Force a collision by auditing a constant hash column.
    ids = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id long, h int")
    audit = keys.hash_audit(ids, "id", "h").first()
    assert (audit.n_ids, audit.n_hashes, audit.n_colliding_hashes, audit.n_colliding_ids) == (3, 2, 1, 2)


def test_quartile_band_nulls_and_counts(spark):
    df = spark.createDataFrame([(i, float(i) if i % 5 else None) for i in range(1, 21)], "track_id long, duration double")
    banded = stats.quartile_band(df)
    counts = {r.quartile: r.n_rows for r in stats.band_counts(banded).collect()}
    assert counts[None] == 4 and sum(counts.values()) == 20


def test_top_terms_keep_ties(spark):
    at = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "z")], "artist_id string, term string")
    top = features.artist_top_terms(at, 1)
    assert top.filter("artist_id = 'a'").count() == 2  # x and y tie at 2
    strict = features.artist_top_term_strict(at)
    assert strict.count() == 3


def test_top_k_scores_brute_force(spark):
    rng = np.random.default_rng(1)
    u = rng.normal(size=(37, 5))
    v = rng.normal(size=(53, 5))
    v[7] = v[3]  # exact score tie, lower id must win
    users = spark.createDataFrame([(i, u[i].tolist()) for i in range(37)], "id long, features array<float>")
    items = spark.createDataFrame([(i, v[i].tolist()) for i in range(53)], "id long, features array<float>")
    got = recommend.top_k_scores(users, items, k=6, user_block_rows=10, item_block_rows=16, chunk_cells=30).toPandas()
    u32, v32 = np.asarray(u, np.float32).astype(float), np.asarray(v, np.float32).astype(float)
    s = u32 @ v32.T
    for i in range(37):
        order = sorted(range(53), key=lambda j: (-s[i, j], j))[:6]
        mine = got[got.user_id == i].sort_values("rank")["item_id"].tolist()
        assert mine == order


def test_nearest_neighbour_brute_force(spark):
    rng = np.random.default_rng(2)
    q = rng.normal(size=(23, 4))
    r = rng.normal(size=(41, 4))
    qs = spark.createDataFrame([(i, q[i].tolist()) for i in range(23)], "id long, x array<double>")
    rs = spark.createDataFrame([(100 + i, r[i].tolist()) for i in range(41)], "id long, x array<double>")
    got = recommend.nearest_neighbour(qs, rs, query_block_rows=8, ref_block_rows=8, chunk_cells=24).toPandas()
    got = got.set_index("query_id")
    d = ((q[:, None, :] - r[None, :, :]) ** 2).sum(-1)
    for i in range(23):
        assert got.loc[i, "ref_id"] == 100 + int(d[i].argmin())


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    y = x @ rng.normal(size=(4, 2)) + rng.normal(scale=0.1, size=(60, 2)) + 3.0
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(60)], "x array<double>, features array<double>")
    mom = coldstart.centred_moments(coldstart.sufficient_statistics(df))
    w, b = coldstart.ridge_fit(mom, 0.5)
    xc, yc = x - x.mean(0), y - y.mean(0)
    w_ref = np.linalg.solve(xc.T @ xc + 0.5 * np.eye(4), xc.T @ yc)
    assert np.allclose(w, w_ref) and np.allclose(b, y.mean(0) - x.mean(0) @ w_ref)
    wl, _ = coldstart.lasso_fit(mom, 1e-6)
    assert np.allclose(wl, np.linalg.lstsq(xc, yc, rcond=None)[0], atol=1e-3)
    wz, _ = coldstart.lasso_fit(mom, 1e3)
    assert np.all(wz == 0)


def test_scaler_population_std_and_zero_variance(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([2.0, 5.0],), ([3.0, 5.0],), ([6.0, 5.0],)], "x array<double>")
    s = coldstart.scaler_stats(df).first()
    assert s["scale"][0] == pytest.approx(np.std([1, 2, 3, 6])) and s["scale"][1] == 1.0
    z = coldstart.standardise(df, coldstart.scaler_stats(df)).toPandas()["x"].tolist()
    assert all(v[1] == 0.0 for v in z)


def test_sample_items_repeatable(spark):
    df = spark.createDataFrame([(u, t, 1) for u in range(3) for t in range(400)], "user_id long, track_id long, count long")
    a = downsample.sample_items(df, 0.5, seed=7).collect()
    b = downsample.sample_items(df.repartition(5), 0.5, seed=7).collect()
    assert sorted(a) == sorted(b) and 120 < len(a) < 280
    rows = downsample.downsample_random_items(df, 0.5, seed=7)
    assert rows.select("track_id").distinct().count() == len(a)


def test_parquet_and_csv_round_trip(spark, tmp_path):
    from playlens.sources import sinks, tables

    df = spark.createDataFrame([(i, i * 2, i * 3) for i in range(50)], "track_id long, unique_plays long, total_plays long")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_usage_csv(spark, str(tmp_path / "csv"), tables.ITEM_USAGE_BIGINT)
    assert back.exceptAll(df).count() == 0 and back.count() == 50
    sinks.write_slices(df, str(tmp_path / "pq"), 10)
    again = tables.read_parquet_dir(spark, str(tmp_path / "pq"))
    assert again.count() == 50
    sinks.write_partitioned(df.withColumn("quartile", F.col("track_id") % 4), str(tmp_path / "part"), "quartile")
    assert tables.read_parquet_dir(spark, str(tmp_path / "part")).count() == 50


def test_real_hash_collisions_are_found(spark):
    # 300k string ids (the reference's key type): about 300k^2 / 2^33 = 10 colliding pairs expected.
    # (BIGINT ids below 2^32 cannot collide: with the high word 0 every Murmur3 step is invertible.)
    ids = spark.range(0, 300_000).select(F.concat(F.lit("TR"), F.col("id").cast("string")).alias("track_id"))
    pairs = keys.hash_collisions(ids, "track_id").toPandas()
    assert len(pairs) >= 2
    assert (pairs.groupby("hash_id").size() >= 2).all()
    audit = keys.hash_audit(ids, "track_id").first()
    assert audit.n_ids == 300_000
    assert audit.n_colliding_ids == len(pairs)
    assert audit.n_hashes == 300_000 - (len(pairs) - pairs["hash_id"].nunique())


def test_lasso_and_ridge_match_spark_ml_linear_regression(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 5))
    y = x @ np.array([1.5, 0.0, -2.0, 0.3, 0.0]) + rng.normal(scale=0.5, size=200) + 1.0
    df = spark.createDataFrame([(x[i].tolist(), [float(y[i])], float(y[i])) for i in range(200)],
                               "x array<double>, features array<double>, label double")
    mom = coldstart.centred_moments(coldstart.sufficient_statistics(df))
    data = df.select(array_to_vector("x").alias("vec"), "label")
    alpha = 0.1
    wl, bl = coldstart.lasso_fit(mom, alpha)
    lasso = LinearRegression(featuresCol="vec", elasticNetParam=1.0, regParam=alpha, standardization=False,
                             tol=1e-12, maxIter=1000).fit(data)
    assert np.allclose(wl[:, 0], lasso.coefficients.toArray(), atol=1e-4)
    assert bl[0] == pytest.approx(lasso.intercept, abs=1e-4)
    # Ridge: alpha on the summed loss equals regParam = alpha / n * std_pop(y) in Spark's scaled loss.
    wr, br = coldstart.ridge_fit(mom, 5.0)
    ridge = LinearRegression(featuresCol="vec", elasticNetParam=0.0, regParam=5.0 / 200 * float(np.std(y)),
                             standardization=False, solver="normal").fit(data)
    assert np.allclose(wr[:, 0], ridge.coefficients.toArray(), atol=1e-6)


@pytest.mark.parametrize("chunk", [1, 3, 7, 64])
def test_stream_top_k_exact_with_ties(chunk):
    rng = np.random.default_rng(4)
    u = rng.integers(-2, 3, size=(9, 3)).astype(float)   # small integers: many exact score ties
    v = rng.integers(-2, 3, size=(40, 3)).astype(float)
    ids = rng.permutation(1000)[:40].astype(np.int64)
    rows, got_ids, scores, rank = recommend.stream_top_k(u, v, ids, 5, chunk)
    s = u @ v.T
    for i in range(9):
        want = sorted(range(40), key=lambda j: (-s[i, j], ids[j]))[:5]
        assert got_ids[rows == i].tolist() == ids[want].tolist()
        assert rank[rows == i].tolist() == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("chunk", [1, 4, 50])
def test_stream_nearest_ties_to_lower_id(chunk):
    q = np.array([[0.0, 0.0], [1.0, 1.0]])
    r = np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [1.0, 1.0], [2.0, 2.0]])
    ids = np.array([30, 20, 10, 40, 5], dtype=np.int64)
    d, best = recommend.stream_nearest(q, r, ids, chunk)
    assert best.tolist() == [10, 40] and d.tolist() == [1.0, 0.0]


def test_split_is_a_partition_of_ids(spark):
    df = spark.range(0, 2000).select(F.col("id"))
    train, holdout = coldstart.split(df, 0.8)
    assert train.join(holdout, "id").count() == 0
    assert train.count() + holdout.count() == 2000
    assert 1500 < train.count() < 1700


def test_split_and_sample_take_any_key(spark):
    thousands = spark.range(0, 2000).select((F.col("id") * 1000 + 5_000_000_000).alias("id"))
    train, _ = coldstart.split(thousands, 0.8)
    assert 1500 < train.count() < 1700
    other, _ = coldstart.split(thousands, 0.8, seed=7)
    assert train.join(other, "id", "left_semi").count() < train.count()
    names = spark.range(0, 4000).select(F.concat(F.lit("TR"), F.col("id")).alias("track_id"))
    a, b = (set(downsample.sample_items(names, 0.25, seed=s).toPandas().track_id) for s in (0, 1))
    assert 800 < len(a) < 1200 and len(a & b) < 0.5 * len(a)
    many = spark.range(0, 3_000_000).withColumnRenamed("id", "track_id")
    assert 0 < downsample.downsample_random_items(many, 1e-5).count() < 100


def test_csv_with_string_ids_and_bad_rows(spark, tmp_path):
    from playlens.sources import sinks, tables

    df = spark.createDataFrame([("TR1", 1, 2), ("TR2", 3, 4)], "track_id string, unique_plays long, total_plays long")
    sinks.write_csv(df, str(tmp_path / "s"))
    assert tables.read_usage_csv(spark, str(tmp_path / "s")).exceptAll(df).count() == 0
    with pytest.raises(Exception):
        tables.read_usage_csv(spark, str(tmp_path / "s"), tables.ITEM_USAGE_BIGINT).collect()


@pytest.mark.parametrize("chunk", [1, 3, 7, 64, 500])
def test_equal_rows_tie_to_the_lower_id_in_any_chunk(chunk):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 33)) * 300
    v = np.concatenate([base, base, base])
    ids = rng.permutation(len(v)).astype(np.int64)
    u = rng.normal(size=(5, 33))
    rows, got, scores, _ = recommend.stream_top_k(u, v, ids, 30, chunk)
    for k in range(5):
        exact = (u[[k]] * v).sum(1)
        want = ids[np.lexsort((ids, -exact))[:30]]
        assert got[rows == k].tolist() == want.tolist()
    near = np.concatenate([base + 1e-6, base, base])
    d, best = recommend.stream_nearest(base, near, ids, chunk)
    assert (d == 0).all() and best.tolist() == np.minimum(ids[40:80], ids[80:]).tolist()


def test_r2_of_a_constant_target_that_is_met(spark):
    rows = spark.createDataFrame([([float(i)], [5.1]) for i in range(20)], "x array<double>, features array<double>")
    model = [("ridge", 1.0, np.zeros((1, 1)), np.array([5.1]))]
    assert coldstart.evaluate_linear(rows, model, centre=np.array([4.7])).first()["r2"] == 1.0


def test_max_records_slices_keep_every_row(spark, tmp_path):
    from playlens.sources import sinks, tables

    df = spark.range(0, 1000).withColumnRenamed("id", "track_id")
    sinks.write_max_records(df, str(tmp_path / "mr"), 128)
    back = tables.read_parquet_dir(spark, str(tmp_path / "mr"))
    assert back.count() == 1000 and back.exceptAll(df).count() == 0
    files = [p for p in (tmp_path / "mr").iterdir() if p.name.endswith(".parquet")]
    assert len(files) >= 8
