"""Sparse item features, exact 1-NN over them, and matrix-free ridge and lasso, against dense brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.operators import coldstart, linear, neighbours, sparse

SONG = "track_id long, artist_id string, duration double, artist_familiarity double, artist_hotttnesss double, year int"


def made_rows(rng, n, terms, coarse=False, patterns=25, most=4):
    """(id, nums, terms) with repeated term sets, a hot one, an empty one, and repeated rows."""
    sets = [[]] + [sorted(rng.choice(terms, rng.integers(1, most + 1), replace=False).tolist()) for _ in range(patterns)]
    out = []
    for i in range(n):
        s = sets[1] if rng.random() < 0.35 else sets[rng.integers(len(sets))]
        nums = rng.integers(0, 3, 2).astype(float) if coarse else rng.normal(size=2) * rng.choice([0.3, 2.0])
        out.append((i, nums.tolist(), s))
    return out


def dense(rows, width, scale, size):
    x = np.zeros((len(rows), width + size))
    for i, (_, nums, terms) in enumerate(rows):
        x[i, :width] = nums
        x[i, [width + t for t in terms]] = 1
    x[:, width:] /= scale
    return x


def brute_nearest(queries, refs, scale):
    q, r = dense(queries, 2, scale, len(scale)), dense(refs, 2, scale, len(scale))
    ids = np.array([i for i, _, _ in refs])
    out = {}
    for (i, _, _), row in zip(queries, q):
        d = np.round(np.sqrt(((r - row) ** 2).sum(1)), 9)
        best = d.min()
        out[i] = (int(ids[d == best].min()), best)
    return out


ROW = "id long, nums array<double>, terms array<int>"


@pytest.mark.parametrize("seed,coarse,block", [(1, False, 8), (2, True, 8), (3, False, 64), (4, True, 5)])
def test_nearest_sparse_matches_brute_force(spark, seed, coarse, block):
    rng = np.random.default_rng(seed)
    size = 40
    refs, queries = made_rows(rng, 300, size, coarse), [(1000 + i, n, t) for i, n, t in made_rows(rng, 120, size, coarse)]
    queries += [(2000, [50.0, -50.0], [1]), (2001, [0.0, 0.0], sorted(range(0, size, 3))), (2002, refs[5][1], refs[5][2])]
    share = rng.uniform(0.02, 0.5, size)
    scale = np.sqrt(share * (1 - share))
    known = [(i, float(scale[i])) for i in range(size) if i % 7]  # the others have no statistics: scale 1
    scale[::7] = 1
    got = neighbours.nearest_sparse(spark.createDataFrame(queries, ROW).repartition(3), spark.createDataFrame(refs, ROW).repartition(3),
                                    spark.createDataFrame(known, "idx int, scale double"), 2, block).collect()
    want = brute_nearest(queries, refs, scale)
    assert {r.query_id: (r.ref_id, round(r.dist, 7)) for r in got} == {k: (a, round(float(d), 7)) for k, (a, d) in want.items()}
    assert len(got) == len(queries)


def test_nearest_sparse_skips_far_blocks(spark):
    """Most row pairs of a clustered table are never compared, though one term set holds a third of all rows."""
    rng = np.random.default_rng(9)
    rows = made_rows(rng, 3000, 400, patterns=120)
    share = rng.uniform(0.002, 0.05, 400)
    scales = spark.createDataFrame([(i, float(np.sqrt(p * (1 - p)))) for i, p in enumerate(share)], "idx int, scale double")
    df = spark.createDataFrame(rows, ROW)
    search = neighbours.plan_search(df.where("id % 5 = 0"), df.where("id % 5 <> 0"), scales, 2, 32)
    done, whole = search.work()
    assert 0 < done < 0.1 * whole
    assert search.refs.agg(F.max("n")).first()[0] <= 32


def test_nearest_sparse_of_empty_sides(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], [2])], ROW)
    scales = spark.createDataFrame([], "idx int, scale double")
    assert neighbours.nearest_sparse(df, df.limit(0), scales, 2).collect() == []
    assert neighbours.nearest_sparse(df.limit(0), df, scales, 2).collect() == []
    assert neighbours.nearest_sparse(df, df, scales, 2).first().dist == 0.0


def test_any_term_name_becomes_a_feature(spark):
    names = ["st. louis", "St. Louis", "ST. LOUIS", "year", "duration", "`tick`", "a`b", "", " ", "x.y.z", "zz last"]
    top = spark.createDataFrame([("a1", t) for t in names[:6]] + [("a2", t) for t in names[5:]], "artist_id string, term string")
    songs = spark.createDataFrame([(1, "a1", None, 0.5, 0.1, 1990), (2, "a2", 3.0, None, 0.2, None), (3, "a3", 1.0, 1.0, 1.0, 2000), (4, None, 1.0, 1.0, 1.0, 1)], SONG)
    terms = sparse.term_dictionary(top)
    assert [r.term for r in terms.orderBy("idx").collect()] == sorted(names)[:-1]
    rows = sparse.sparse_features(songs, top, terms)
    cells = sparse.long_cells(rows, terms).collect()
    got = {(r.track_id, r.feature, r.value) for r in cells if r.feature not in ("duration", "year")}
    assert len(cells) == 4 * (4 + len(names) - 1)
    for t in sorted(names)[:-1]:
        if t not in ("duration", "year"):
            assert (1, t, 1.0 if t in names[:6] else 0.0) in got and (3, t, None) in got and (4, t, None) in got
    assert {(r.value) for r in cells if r.track_id == 1 and r.feature == "year"} == {1990.0, 1.0}
    kept = sparse.term_dictionary(top, drop_level="year")
    assert "zz last" in {r.term for r in kept.collect()} and "year" not in {r.term for r in kept.collect()}


def test_twenty_thousand_terms_stay_off_the_driver(spark, monkeypatch):
    """A vocabulary twice the pivot limit goes through features, scaling, 1-NN and both fits; nothing of its size but the model is collected."""
    rng = np.random.default_rng(5)
    artists = [(f"a{i}", f"term {(7 * i + j) % 20011}") for i in range(10_000) for j in range(3)]
    top = spark.createDataFrame(artists, "artist_id string, term string")
    songs = spark.createDataFrame([(i, f"a{(i * 13) % 11_000}", float(rng.normal()), float(rng.normal()), 0.5, int(rng.integers(50))) for i in range(600)], SONG)
    collected = []
    collect = type(top).collect
    monkeypatch.setattr(type(top), "collect", lambda self: collected.append(len(out := collect(self))) or out)
    terms = sparse.term_dictionary(top)
    rows = sparse.sparse_features(songs, top, terms)
    factors = songs.select(F.col("track_id").alias("id"), F.array((F.col("year") / 50.0).cast("float"), F.lit(1.0).cast("float")).alias("features"))
    scaled = coldstart.prepare(factors, coldstart.identity_dictionary(songs), rows, terms)
    assert scaled.size == 20_010 + 4
    predictions = coldstart.knn_predict(scaled)
    assert predictions.count() == scaled.holdout.count() and max(collected, default=0) <= 2
    vocabulary = {r.term: r.idx for r in collect(terms)}
    assert len(vocabulary) == 20_010 and sorted(vocabulary.values()) == list(range(20_010))
    stats, b, models = linear.fit_grid(scaled, [10.0], ("ridge",))
    assert max(collected) <= 20  # blocks of the model
    assert linear.ridge_residual(scaled, stats, b, models[0][2], 10.0) < 1e-8


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(7)
    rows = made_rows(rng, 400, 12, patterns=20)
    w = rng.normal(size=(14, 3))
    y = dense(rows, 2, np.ones(12), 12) @ w + rng.normal(size=(400, 3)) * 0.1 + 5
    table = spark.createDataFrame([(i, i, y[k].tolist(), n, t) for k, (i, n, t) in enumerate(rows)],
                                  "id long, track_id long, features array<double>, nums array<double>, terms array<int>")
    terms = spark.createDataFrame([(f"t{i:02d}", i) for i in range(12)], "term string, idx int")
    scaled = sparse.standardise(table.repartition(3), F.col("id") % 5 != 0, terms, width=2)
    stats = linear.frame(scaled)
    return scaled, stats, linear.cross_product(scaled, stats), terms


def dense_moments(fitted):
    """(moments, standardised matrix, targets) of the training rows, made densely."""
    scaled, stats, _, _ = fitted
    rows = sorted(scaled.train.collect(), key=lambda r: r.id)
    x = np.zeros((len(rows), 14))
    for i, r in enumerate(rows):
        x[i, :2] = r.nums
        x[i, [2 + t for t in r.terms]] = 1
    sd = x[:, 2:].std(0)
    x[:, 2:] = (x[:, 2:] - x[:, 2:].mean(0)) / np.where(sd == 0, 1, sd)
    y = np.array([r.features for r in rows])
    xc, yc = x - x.mean(0), y - y.mean(0)
    return {"n": len(x), "mx": x.mean(0), "my": y.mean(0), "G": xc.T @ xc, "C": xc.T @ yc}, x, y


def test_sparse_standardisation_and_products(spark, fitted):
    scaled, stats, b, terms = fitted
    mom, x, _ = dense_moments(fitted)
    assert np.allclose(b, mom["C"], atol=1e-8)
    assert np.allclose(linear.normal_product(scaled, stats, np.eye(14)), mom["G"], atol=1e-8)
    gram = {(r.i, r.j): r.value for r in sparse.gram_cells(scaled).collect()}
    assert len(gram) == 14 * 14 and all(abs(gram[i, j] - (x.T @ x)[i, j]) < 1e-8 for i in range(14) for j in range(14))
    ids = [r.id for r in sorted(scaled.train.collect(), key=lambda r: r.id)]
    cells = {(r.id, r.pos): r.z for r in sparse.scaled_cells(scaled, scaled.train, terms).collect()}
    assert len(cells) == x.size and all(abs(cells[i, j] - x[k, j]) < 1e-12 for k, i in enumerate(ids) for j in range(14))


@pytest.mark.parametrize("values", [linear.VALUES, 60])
def test_ridge_and_lasso_match_dense_solvers(fitted, monkeypatch, values):
    monkeypatch.setattr(linear, "VALUES", values)  # 60: four targets a group
    scaled, stats, b, _ = fitted
    mom, _, _ = dense_moments(fitted)
    alphas = [0.01, 0.3, 100.0]
    for alpha, (w, c) in zip(alphas, linear.ridge(scaled, stats, b, alphas)):
        want, _ = coldstart.ridge_fit(mom, alpha)
        assert np.allclose(w, want, atol=1e-7) and np.allclose(c, mom["my"])
        assert linear.ridge_residual(scaled, stats, b, w, alpha) < 1e-9
    for alpha, (w, c) in zip(alphas, linear.lasso(scaled, stats, b, alphas)):
        want, _ = coldstart.lasso_fit(mom, alpha)
        assert np.allclose(w, want, atol=1e-6) and linear.lasso_residual(scaled, stats, b, w, alpha) < 1e-8
        assert alpha < 100 or not w.any()


def test_linear_scores_match_dense(spark, fitted):
    scaled, stats, b, _ = fitted
    models = [("ridge", 1.0, *linear.ridge(scaled, stats, b, [1.0])[0]), ("zero", 0.0, np.zeros((14, 3)), stats.y_mean)]
    got = {r.model: r for r in linear.evaluate(scaled.train, stats, models).collect()}
    _, x, y = dense_moments(fitted)
    for name, _, w, c in models:
        res = y - x @ w - c
        assert got[name].mse == pytest.approx((res**2).mean(), abs=2e-6)
        assert got[name].r2 == pytest.approx((1 - (res**2).sum(0) / ((y - y.mean(0)) ** 2).sum(0)).mean(), abs=2e-6)
    assert linear.evaluate(scaled.train.limit(0), stats, models).collect() == []


def test_hashed_search_finds_nine_in_ten_exact_neighbours(spark):
    """Random-hyperplane buckets with multi-probe: recall against the exact search, repeatable by seed."""
    rng = np.random.default_rng(12)
    rows = spark.createDataFrame(made_rows(rng, 1500, 30, patterns=40), ROW)
    terms = spark.createDataFrame([(f"t{i:02d}", i) for i in range(30)], "term string, idx int")
    scaled = sparse.standardise(rows, F.col("id") % 5 != 0, terms, width=2)
    exact = {r.query_id: r.dist for r in neighbours.nearest_sparse(scaled.holdout, scaled.train, scaled.terms, 2).collect()}
    got = {r.query_id: (r.ref_id, r.dist) for r in neighbours.nearest_hashed(scaled.holdout, scaled.train, scaled.terms, 2).collect()}
    hits = sum(i in got and abs(got[i][1] - d) < 1e-7 for i, d in exact.items())
    assert hits >= 0.9 * len(exact) and all(d >= exact[i] - 1e-7 for i, (_, d) in got.items())
    few = neighbours.Planes(tables=1, bits=10, probes=1, seed=3)
    one, again = (sorted(map(tuple, neighbours.nearest_hashed(part, scaled.train, scaled.terms, 2, few).collect()))
                  for part in (scaled.holdout, scaled.holdout.repartition(3)))
    assert one == again and len(one) <= len(exact)
    assert neighbours.nearest_hashed(scaled.holdout, scaled.train.limit(0), scaled.terms, 2).collect() == []
