"""Every registered query against its DuckDB oracle (small scale), plus ALS and entry smoke checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SQL_KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert res["status"] == "match", res


def test_every_key_has_a_builder():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    row = entry.entry(spark).first()
    assert row["n_users"] > 0 and 0 <= row["map"] <= 1


def test_als_seeded_fit_is_repeatable_and_reloads(spark, tmp_path):
    from playlens.operators import recommend
    from playlens.plans.rec_queries import _als_inputs
    from playlens.sources import sinks

    train, val = _als_inputs(spark, SF_SMALL)
    m1 = recommend.fit_als(train, rank=4, reg=0.1, max_iter=3)
    m2 = recommend.fit_als(train.repartition(3), rank=4, reg=0.1, max_iter=3)
    f1 = {r.id: r.features for r in m1.itemFactors.collect()}
    f2 = {r.id: r.features for r in m2.itemFactors.collect()}
    assert f1.keys() == f2.keys()
    assert max(abs(a - b) for k in f1 for a, b in zip(f1[k], f2[k])) < 1e-4
    sinks.save_model(m1, str(tmp_path / "als"))
    again = sinks.load_model(str(tmp_path / "als"))
    assert again.rank == 4 and again.itemFactors.count() == len(f1)


def test_blocked_als_recommendations_match_builtin(spark):
    from playlens.operators import recommend
    from playlens.plans.rec_queries import _als_inputs

    train, val = _als_inputs(spark, SF_SMALL)
    model = recommend.fit_als(train, rank=4, reg=0.1, max_iter=3)
    ours = recommend.als_recommendations(model, val, 20, block_rows=16)
    theirs = recommend.als_builtin_recommendations(model, val, 20)
    # Same users, same list lengths, same scores position by position (ties may swap ids).
    a = ours.select("user_hashId", "rank", F.round(F.col("rating").cast("double"), 4).alias("r"))
    b = theirs.select("user_hashId", "rank", F.round(F.col("rating").cast("double"), 4).alias("r"))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() <= 0.01 * a.count()


def test_als_grid_rows(spark):
    from playlens.operators import recommend
    from playlens.plans.rec_queries import _als_inputs

    train, val = _als_inputs(spark, SF_SMALL)
    grid = recommend.als_grid(train, val, ranks=(2, 4), regs=(0.1,), max_iter=2, k=50).collect()
    assert len(grid) == 2 and all(0 <= r["map"] <= 1 and r["n_users"] > 0 for r in grid)


def test_als_metrics_are_those_of_the_lists(spark):
    from playlens.operators import metrics, recommend

    train = spark.createDataFrame([(u, t, 1 + (u * t) % 5) for u in range(40) for t in range(60) if (u * 7 + t * 3) % 4 == 0], "user_hashId int, track_hashId int, count long")
    truth = spark.createDataFrame([(u, t) for u in range(5, 50) for t in range(u % 3, 70, 6)] + [(6, None), (None, 3), (39, None)], "user_hashId int, track_hashId int").distinct()
    model = recommend.fit_als(train, rank=3, reg=0.1, max_iter=2)
    want = metrics.list_metrics(recommend.als_lists(model, truth, 25), truth, "user_hashId", "track_hashId", "items").first()
    assert recommend.als_metrics(model, truth, 25).first() == want and want.n_users == 35 and want["map"] > 0


def test_als_fits_leave_one_setting_alone_on_many_ratings(spark, monkeypatch):
    import threading

    from playlens.operators import recommend

    train = spark.createDataFrame([(u, t, 1) for u in range(30) for t in range(u % 4, 40, 4)], "user_hashId int, track_hashId int, count long")
    running, most, lock, fit = [0], [0], threading.Lock(), recommend._fit_als

    def counted(*args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit(*args)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(recommend, "_fit_als", counted)
    grids = []
    for limit in (10**6, train.count()):
        monkeypatch.setattr(recommend, "SIDE_BY_SIDE", limit)
        most[0] = 0
        grids.append((sorted(recommend.als_grid(train, train, (2,), (0.1, 1.0), 1, 10).collect()), most[0]))
    assert grids[0][0] == grids[1][0] and grids[0][1] == 2 and grids[1][1] == 1
