"""Exactly sized splits, joins with heavy keys, hash collisions, files of planned size."""

from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playlens.functions import select, skew
from playlens.operators import coldstart, downsample, features, metrics, recommend
from playlens.sources import sinks


@pytest.mark.parametrize("n,share", [(1000, 0.8), (1000, 0.5), (7, 0.8), (1, 0.8), (1, 0.2), (0, 0.8), (333, 0.0), (333, 1.0)])
def test_exact_split_has_the_stated_size(spark, n, share):
    df = spark.range(n).select((F.col("id") * 7919).alias("id"), F.lit("x").alias("h")).repartition(3)
    train, holdout = coldstart.exact_split(df, share)
    a, b = {r.id for r in train.collect()}, {r.id for r in holdout.collect()}
    assert len(a) == int(share * n + 0.5) and not a & b and len(a | b) == n


def test_exact_split_is_seeded_and_the_least_by_hash(spark):
    df = spark.createDataFrame([(f"user {i}",) for i in range(500)] + [(None,)], "id string")
    one, again, other = ({r.id for r in coldstart.exact_split(part, 0.3, seed=s)[0].collect()} for part, s in ((df, 1), (df.repartition(5), 1), (df, 2)))
    assert one == again != other and len(one) == len(other) == 150
    hashes = {r.id: r.h for r in df.select("id", select.seeded_hash("id", 1).alias("h")).collect()}
    assert max(hashes[i] for i in one) <= min(hashes[i] for i in set(hashes) - one)


def test_exact_split_among_equal_hashes(spark, monkeypatch):
    """With eight hash values only, the cut falls among many ids of one hash: the least ids go to train."""
    real = select.seeded_hash
    monkeypatch.setattr(select, "seeded_hash", lambda c, s: real(c, s) % 8 * 70_000)
    rows = [(i,) for i in random.Random(3).sample(range(10**6), 400)] + [(None,)]
    df = spark.createDataFrame(rows, "id long").repartition(4)
    key = {r.id: r.h for r in df.select("id", select.seeded_hash("id", 5).alias("h")).collect()}
    order = sorted(key, key=lambda i: (key[i], i is not None, i or 0))
    for k in (1, 57, 200, 399, 400, 401):
        got = {r.id for r in df.filter(select.least_hashes(df, k, "id", 5)).collect()}
        assert got == set(order[:k])


def test_join_unique_with_heavy_keys(spark):
    rng = random.Random(2)
    left = [(rng.choice(["hot", "hot", *"abcdef"]), i) for i in range(3000)] + [(None, -1), ("absent", -2)]
    counts = Counter(k for k, _ in left if k not in (None, "absent"))
    right = spark.createDataFrame(list(counts.items()), "k string, w long")
    df = spark.createDataFrame(left, "k string, i int")
    got = skew.join_unique(df, right, "k", "w", least_rows=500)
    assert sorted(map(tuple, got.select("i", "k", "w").collect())) == sorted((i, k, counts[k]) for k, i in left if k in counts)
    assert right.where(skew.heavy_bound(right, "w", 500)).count() == 1
    assert right.where(skew.heavy_bound(right, "w")).count() == 0


def test_term_counts_join_keeps_rows_of_a_frequent_term(spark, monkeypatch):
    monkeypatch.setattr(features, "join_unique", lambda *a: skew.join_unique(*a, least_rows=50))
    rows = [(f"a{i}", "pop") for i in range(300)] + [(f"a{i}", f"t{i % 40}") for i in range(300)]
    got = features.artist_term_counts(spark.createDataFrame(rows, "artist_id string, term string")).collect()
    count = Counter(t for _, t in rows)
    assert sorted((r.artist_id, r.term, r.term_count) for r in got) == sorted((a, t, count[t]) for a, t in rows)


def test_copies_of_a_heavy_user_spread_over_tasks(spark):
    """A user with a third of all train rows and many val rows: equal to the plain join, and dealt to many tasks."""
    rng = random.Random(1)
    train = [("hot" if i % 3 == 0 else f"u{rng.randrange(50)}", i, 1) for i in range(900)]
    val = [("hot", i, 2) for i in range(2500)] + [(f"u{rng.randrange(60)}", i, 2) for i in range(200)]
    t, v = (spark.createDataFrame(x, "user_id string, track_id int, count int") for x in (train, val))
    got = downsample.restrict_to_users_repeated(t, v, least_rows=1000)
    want = t.join(v.select("user_id"), "user_id").groupBy(*t.columns).agg(F.count("*").alias("copies"))
    assert got.groupBy(*t.columns).agg(F.count("*").alias("copies")).exceptAll(want).count() == 0
    assert got.count() == want.agg(F.sum("copies")).first()[0]
    parts = got.where("user_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()
    whole = sum(r.c for r in parts)
    assert whole == 300 * 2500 and len(parts) >= 6 and max(r.c for r in parts) < 0.4 * whole


def test_hash_collisions_resolve_to_the_least_track(spark):
    h = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1), ("c", 2), ("d", 3), ("e", None)], "track_id string, item_id long")
    chains = {r.item_id: (r.n_tracks, r.track_id, r.chain) for r in coldstart.collision_chains(h.where("item_id is not null")).collect()}
    assert chains == {1: (2, "a", ["a", "b"]), 2: (1, "c", ["c"]), 3: (1, "d", ["d"])}
    v = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (9, [9.0])], "id long, features array<double>")
    m = spark.createDataFrame([("b", [5.0], [1]), ("a", [4.0], [0]), ("c", [3.0], [])], "track_id string, nums array<double>, terms array<int>")
    got = [(r.id, r.track_id, r.n_tracks, r.nums) for r in coldstart.hashed_training_table(v, h, m).orderBy("id").collect()]
    assert got == [(1, "a", 2, [4.0]), (2, "c", 1, [3.0])]
    # The least track with features survives: without "a", id 1 is "b".
    got = [(r.id, r.track_id, r.n_tracks) for r in coldstart.hashed_training_table(v, h, m.where("track_id <> 'a'")).orderBy("id").collect()]
    assert got == [(1, "b", 2), (2, "c", 1)]
    ranged = coldstart.sorted_dictionary(h)
    assert sorted(map(tuple, ranged.collect()), key=str) == sorted(map(tuple, h.collect()), key=str)


def test_sized_slices(spark, tmp_path):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, "%030x" % rng.getrandbits(120)) for i in range(20_000)], "i int, s string")
    path = str(tmp_path / "sized")
    files = sinks.write_sized(df, path, 100_000)
    sizes = [os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")]
    assert files == len(sizes) >= 3 and all(50_000 <= s <= 200_000 for s in sizes)
    assert spark.read.parquet(path).exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 20_000
    assert sinks.write_sized(df.limit(0), str(tmp_path / "none")) == 1 and spark.read.parquet(str(tmp_path / "none")).count() == 0


def factor_frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(c) for c in row]) for i, row in enumerate(x)], "id long, features array<float>")


@pytest.mark.parametrize("equal_norms", [False, True])
def test_bounded_top_k_skips_blocks_and_stays_exact(spark, equal_norms):
    """Users skip item blocks whose norms cannot reach their k-th score; the rows are those of brute force."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(600, 6))
    v = v / np.linalg.norm(v, axis=1, keepdims=True) * (1.0 if equal_norms else rng.pareto(1.5, size=(600, 1)) + 0.05)
    v[40:44] = v[300]  # ties
    v[7] = 0
    u = rng.normal(size=(50, 6))
    u[3] = 0
    users, items = factor_frame(spark, u, 1000), factor_frame(spark, v)
    u, v = u.astype(np.float32).astype(float), v.astype(np.float32).astype(float)
    k = 12
    search = recommend.BoundedTopK(users, items, k, 4, 40)
    pairs, whole = search.open_pairs(search.first()).count(), 50 * (len(search.blocks) - 1)
    assert len(search.blocks) >= 6 and (0.9 * whole < pairs if equal_norms else 0 < pairs < 0.5 * whole)
    got = {}
    for r in recommend.top_k_scores(users, items, k, 16, 40).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.item_id))
    for i, row in enumerate(u):
        s = (row * v).sum(1)
        want = sorted(range(600), key=lambda j: (-s[j], j))[:k]
        assert [j for _, j in sorted(got[1000 + i])] == want


def test_bounded_top_k_with_fewer_items_than_k(spark):
    users, items = factor_frame(spark, np.ones((3, 2))), factor_frame(spark, np.arange(20).reshape(10, 2))
    rows = recommend.top_k_scores(users, items, 50, 2, 3).collect()
    assert len(rows) == 30 and {r.rank for r in rows} == set(range(1, 11))
    assert recommend.top_k_scores(users.limit(0), items, 5, 2, 3).collect() == []
    assert recommend.top_k_scores(users, items.limit(0), 5, 2, 3).collect() == []


def _peak(call) -> float:
    import tracemalloc

    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_top_k_holds_little_beside_its_lists_when_all_items_tie():
    u, v = np.ones((1000, 4), np.float32), np.ones((20_000, 4), np.float32)
    ids = np.random.default_rng(3).permutation(len(v)).astype(np.int64)
    found = []
    peak = _peak(lambda: found.append(recommend.stream_top_k(u, v, ids, 40, 2048)))
    rows, items, scores, rank = found[0]
    assert items.reshape(1000, 40).tolist() == [list(range(40))] * 1000 and (scores == 4).all()
    assert rank.reshape(1000, 40).tolist() == [list(range(1, 41))] * 1000 and rows.tolist() == np.repeat(np.arange(1000), 40).tolist()
    assert peak < 64


def test_top_k_stops_where_norms_leave_nothing_to_gain(monkeypatch):
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(300, 8)), rng.normal(size=(20_000, 8))
    v[rng.permutation(len(v))[1000:]] *= 0.01  # the others hold every list
    passes, where = [], recommend._where
    monkeypatch.setattr(recommend, "_where", lambda mask: passes.append(mask.shape) or where(mask))
    rows, ids, scores, _ = recommend.stream_top_k(u, v, np.arange(len(v)), 20, 1000)
    every = u @ v.T
    best = np.lexsort((np.broadcast_to(np.arange(len(v)), every.shape), -every), axis=1)[:, :20]
    assert ids.reshape(300, 20).tolist() == best.tolist()
    assert len(passes) == 2  # one chunk of 20 for each of two groups of users


@pytest.mark.parametrize("factor", [1e-40, 1.0, 1e35])
def test_top_k_of_scores_that_float32_cannot_hold(factor):
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(40, 6)) * factor, rng.normal(size=(500, 6))
    v[::7] = v[0]
    rows, ids, scores, _ = recommend.stream_top_k(u, v, np.arange(500), 60, 32)
    every = np.array([(u[i] * v).sum(1) for i in range(40)])
    best = np.array([np.lexsort((np.arange(500), -s))[:60] for s in every])
    assert ids.reshape(40, 60).tolist() == best.tolist()
    assert scores.reshape(40, 60).tolist() == np.take_along_axis(every, best, 1).tolist()


def test_lists_have_a_row_per_user_and_score_like_their_long_form(spark):
    rng = np.random.default_rng(6)
    rows = lambda n: [(i, [float(x) for x in rng.normal(size=3)]) for i in range(n)]
    users, items = (spark.createDataFrame(rows(n), "id long, features array<float>") for n in (30, 200))
    for item_rows in (1000, 40):  # one block, several
        lists = recommend.top_k_lists(users, items, 12, 16, item_rows)
        got = {r.user_id: r["items"] for r in lists.collect()}
        assert len(got) == 30 and lists.count() == 30 and all(len(x) == 12 for x in got.values())
        truth = spark.createDataFrame([(u, t) for u in range(5, 40) for t in range(0, 200, 3)] * 2 + [(6, None), (None, 3)], "user_id long, track_id long")
        by_list = metrics.list_metrics(lists, truth, "user_id", "track_id", "items").first()
        assert by_list == metrics.ranking_metrics(recommend.listed(lists).withColumnRenamed("item_id", "track_id"), truth).first()
        assert by_list.n_users == 25 and by_list["map"] > 0


def test_top_k_shuffles_no_item_per_user_block_and_writes_no_list(spark):
    """One cartesian pass: more blocks of users do not send the items again, and no list is on disk before the result is read."""
    rng = np.random.default_rng(8)
    users, items = factor_frame(spark, rng.normal(size=(400, 4))), factor_frame(spark, rng.normal(size=(3000, 4)))
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    lists = recommend.top_k_lists(users, items, 500, 10, 700)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Exchange" not in plan
    new = [os.path.join(d, f) for n in set(os.listdir(folder)) - before for d, _, fs in os.walk(os.path.join(folder, n)) for f in fs]
    assert sum(map(os.path.getsize, new)) < 400 * 500 * 4
    assert lists.count() == 400 and lists.where("size(items) = 500").count() == 400


def test_packed_rows_keep_order_types_and_values():
    x = pa.array([[float(i), -float(i)] for i in range(25)], pa.list_(pa.float32()))
    table = pa.table({"id": pa.array(range(25), pa.int32()), "features": x})
    for rows, want in ((10, [10, 10, 5]), (None, [25]), (5, [5] * 5)):
        parts = [recommend._read_ipc(b.column(0)[0].as_buffer()) for b in recommend._pack(rows)(iter(table.to_batches(max_chunksize=7)))]
        assert [p.num_rows for p in parts] == want and pa.concat_tables(parts).equals(table.combine_chunks())
    assert list(recommend._pack(3)(iter([]))) == []


def test_lists_do_not_depend_on_how_items_pass_by():
    rng = np.random.default_rng(9)
    u, v, ids = rng.normal(size=(300, 5)), np.repeat(rng.normal(size=(400, 5)), 3, axis=0), rng.permutation(1200)
    v[50] = np.nan
    tables = [pa.table({"id": pa.array(i), "features": pa.array(list(x), pa.list_(pa.float64()))}) for i, x in ((np.arange(300), u), (ids, v))]
    keep = ids != ids[50]
    _, want, _, _ = recommend.stream_top_k(u, v[keep], ids[keep], 20, 64)
    for step in (1200, 333, 15):  # in no order of norms, and fewer at once than k
        lists = recommend._UserLists(tables[0], 20, 4096)
        for i in range(0, 1200, step):
            lists.add(tables[1].slice(i, step))
        got = list(lists.rows())
        assert [i for i, _, _ in got] == list(range(300)) and np.concatenate([x for _, x, _ in got]).tolist() == want.tolist()
