"""Cold start: learn item factors from metadata for items held out of the factor model.

Training table: factor rows V joined to the item dictionary H and to the sparse feature rows M (J9).
Split: a repeatable hash-bucket holdout. The features are standardised with train statistics and stay sparse.
Then one of three learners:

- 1-nearest-neighbour: exact search by inverted index and bounds (``neighbours.nearest_sparse``)
- ridge and lasso: matrix-free fits by passes over the rows (``linear``)

The dense forms below (``scaler_stats``, ``sufficient_statistics``, ``ridge_fit``, ``lasso_fit``) are for tables of
a few features: they take d x d statistics to the driver, and the cold-start flow does not use them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.keys import seeded_unit
from playlens.functions.select import least_hashes
from playlens.operators import linear
from playlens.operators.metrics import multi_output_errors, r2_score
from playlens.operators.neighbours import BLOCK, nearest_sparse
from playlens.operators.recommend import _matrix
from playlens.operators.sparse import Scaled, filled
from playlens.operators.sparse import standardise as standardise_sparse

# Holdout rule: an id is in train when its seeded hash, as a share of the hash range, is below 0.8.
SPLIT_SEED = 42


def identity_dictionary(items: DataFrame, item_col: str = "track_id") -> DataFrame:
    """Item dictionary for integer keys used directly as factor ids: (track_id, item_id)."""
    return items.select(F.col(item_col).alias("track_id"), F.col(item_col).alias("item_id")).distinct()


def collision_chains(dictionary: DataFrame, item_col: str = "item_id", track_col: str = "track_id") -> DataFrame:
    """(item_id, n_tracks, track_id, chain): the tracks behind each hash id, in order; the least one survives.

    A chain is as long as there are collisions on one id, which the width of the hash keeps short.
    """
    tracks = dictionary.select(F.col(item_col).alias("item_id"), F.col(track_col).alias("track_id")).distinct()
    return tracks.groupBy("item_id").agg(F.count("*").alias("n_tracks"), F.min("track_id").alias("track_id"),
                                         F.array_sort(F.collect_list("track_id")).alias("chain"))


def sorted_dictionary(dictionary: DataFrame, item_col: str = "item_id", track_col: str = "track_id") -> DataFrame:
    """The dictionary in ranges of the hash id: written as Parquet, a lookup reads the row groups of its ids only."""
    n = int(dictionary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dictionary.repartitionByRange(n, item_col, track_col).sortWithinPartitions(item_col, track_col)


def hashed_training_table(factors: DataFrame, dictionary: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, track_id, n_tracks, features, M's columns): V x H on the hash id, then x M, one row per id.

    A hash id with several tracks fans out to all that have features; the least such track survives, and
    ``n_tracks`` says how many the dictionary has for the id.
    """
    chains = collision_chains(dictionary).select(F.col("item_id").alias("id"), "n_tracks")
    kept_rows = dedup_by_id(training_table(factors, dictionary, rows))
    return kept_rows.join(chains, "id").select("id", "track_id", "n_tracks", *[c for c in kept_rows.columns if c not in ("id", "track_id")])


def training_table(factors: DataFrame, dictionary: DataFrame, vectors: DataFrame) -> DataFrame:
    """(id, track_id, features, M's columns): V x H on the factor id, then x M on the track id."""
    vh = factors.join(dictionary, factors["id"] == dictionary["item_id"]).select("id", "track_id", "features")
    return vh.join(vectors, "track_id").select("id", "track_id", "features", *[c for c in vectors.columns if c != "track_id"])


def dedup_by_id(df: DataFrame, id_col: str = "id", survivor_col: str = "track_id") -> DataFrame:
    """One row per id; when a join fanned out (hash collisions), keep the lowest ``survivor_col``."""
    others = [c for c in df.columns if c != id_col]
    best = df.groupBy(id_col).agg(F.min_by(F.struct(*others), F.col(survivor_col)).alias("_r"))
    return best.select(id_col, *[F.col(f"_r.{c}").alias(c) for c in others])


def in_train(id_col: str = "id", train_share: float = 0.8, seed: int = SPLIT_SEED) -> Column:
    """Whether the id (of any type) falls in the train share; another seed gives another split."""
    return seeded_unit(id_col, seed) < F.lit(float(train_share))


def split(table: DataFrame, train_share: float = 0.8, id_col: str = "id",
          seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train and holdout parts: one predicate and its complement, so they never overlap."""
    flag = in_train(id_col, train_share, seed)
    return table.filter(flag), table.filter(~flag)


def scaler_stats(train: DataFrame, x_col: str = "x") -> DataFrame:
    """One row (mean array, scale array): per position mean and population std (1 when 0).

    Positions are exploded and aggregated with partial sums: d groups, no row gathering.
    """
    cells = train.select(F.posexplode(x_col).alias("pos", "v"))
    per_pos = cells.groupBy("pos").agg(F.avg("v").alias("mu"), F.stddev_pop("v").alias("sd"))
    ordered = per_pos.agg(F.sort_array(F.collect_list(F.struct("pos", "mu", "sd"))).alias("_s"))
    return ordered.select(
        F.transform("_s", lambda s: s["mu"]).alias("mean"),
        F.transform("_s", lambda s: F.when(s["sd"] == 0, F.lit(1.0)).otherwise(s["sd"])).alias("scale"),
    )


def standardise(df: DataFrame, stats: DataFrame, x_col: str = "x", out_col: str = "x") -> DataFrame:
    """(x - mean) / scale element-wise; the statistics enter as scalar subqueries (one row)."""
    # One scalar subquery for both arrays. Subqueries may not sit inside a lambda, so the
    # statistics are projected as a column first.
    with_stats = df.withColumn("_st", stats.select(F.struct("mean", "scale")).scalar())
    z = F.transform(F.col(x_col), lambda v, i: (v - F.col("_st.mean")[i]) / F.col("_st.scale")[i])
    return with_stats.withColumn(out_col, z).drop("_st")


def exact_split(table: DataFrame, train_share: float = 0.8, id_col: str = "id", seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train and holdout parts of exact size: round(share x rows) rows train, those with the least (hash, id).

    ``table`` has one row per id. The parts never overlap and together are the table.
    """
    k = math.floor(train_share * table.count() + 0.5)
    flag = least_hashes(table, k, id_col, seed)
    return table.filter(flag), table.filter(~flag)


def prepare(factors: DataFrame, dictionary: DataFrame, rows: DataFrame, terms: DataFrame, train_share: float = 0.8) -> Scaled:
    """Training table of sparse rows, split and standardised with the train statistics.

    ``rows`` are ``sparse_features`` and ``terms`` their dictionary.
    """
    table = dedup_by_id(training_table(factors, dictionary, filled(rows)))
    return standardise_sparse(table, in_train("id", train_share), terms)


def knn_predict(scaled: Scaled, block_rows: int = BLOCK) -> DataFrame:
    """(id, neighbor_id, dist, features, truth): the nearest train item's factors for each holdout item."""
    nn = nearest_sparse(scaled.holdout, scaled.train, scaled.terms, scaled.width, block_rows)
    ref = scaled.train.select(F.col("id").alias("ref_id"), F.col("features").alias("pred"))
    truth = scaled.holdout.select(F.col("id").alias("query_id"), F.col("features").alias("truth"))
    out = nn.join(ref, "ref_id").join(truth, "query_id")
    return out.select(F.col("query_id").alias("id"), F.col("ref_id").alias("neighbor_id"), "dist",
                      F.col("pred").alias("features"), "truth")


def patched_factors(train: DataFrame, predictions: DataFrame) -> DataFrame:
    """V': train items keep their factors, holdout items take the predicted ones.

    Both parts are already one row per id (``dedup_by_id`` before the split) and the split puts
    every id on exactly one side, so the union needs no second dedup.
    """
    return train.select("id", "features").unionByName(predictions.select("id", "features"))


def knn_errors(predictions: DataFrame) -> DataFrame:
    return multi_output_errors(predictions, "truth", "features")


# ------------------------------------------------------------------------------------------
# Linear models of a few dense features, from sufficient statistics


def _moment_rows(x_col: str, y_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sx, sy, xx, xy = 0, None, None, None, None
        for pdf in batches:
            if pdf.empty:
                continue
            x, y = _matrix(pdf[x_col]), _matrix(pdf[y_col])
            if sx is None:
                sx, sy = np.zeros(x.shape[1]), np.zeros(y.shape[1])
                xx, xy = np.zeros((x.shape[1], x.shape[1])), np.zeros((x.shape[1], y.shape[1]))
            n += len(x)
            sx += x.sum(0)
            sy += y.sum(0)
            xx += x.T @ x
            xy += x.T @ y
        if sx is None:
            return
        parts = [("n", np.array([[n]], dtype=float)), ("sx", sx[None, :]), ("sy", sy[None, :]), ("xx", xx), ("xy", xy)]
        for name, m in parts:
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"block": name, "i": i.ravel().astype("int32"), "j": j.ravel().astype("int32"),
                                "value": m.ravel()})

    return run


def sufficient_statistics(train: DataFrame, x_col: str = "x", y_col: str = "features") -> DataFrame:
    """Long rows (block, i, j, value) of n, sum x, sum y, X'X, X'Y: per-partition partial sums in
    NumPy, then added up by Spark. The result has (d + 1)(d + r) + 1 rows whatever the data size."""
    parts = train.select(x_col, y_col).mapInPandas(
        _moment_rows(x_col, y_col), "block string, i int, j int, value double")
    return parts.groupBy("block", "i", "j").agg(F.sum("value").alias("value"))


def _assemble(stats: DataFrame) -> dict[str, np.ndarray]:
    rows = stats.collect()  # bounded: feature x factor dimensions
    shapes: dict[str, tuple[int, int]] = {}
    for r in rows:
        i, j = shapes.get(r["block"], (0, 0))
        shapes[r["block"]] = (max(i, r["i"] + 1), max(j, r["j"] + 1))
    out = {k: np.zeros(s) for k, s in shapes.items()}
    for r in rows:
        out[r["block"]][r["i"], r["j"]] = r["value"]
    return out


def centred_moments(stats: DataFrame) -> dict[str, np.ndarray]:
    """Centred cross products G = Xc'Xc, C = Xc'Yc plus means, from the summed statistics."""
    m = _assemble(stats)
    n = m["n"][0, 0]
    mx, my = m["sx"][0] / n, m["sy"][0] / n
    return {"n": n, "mx": mx, "my": my, "G": m["xx"] - n * np.outer(mx, mx), "C": m["xy"] - n * np.outer(mx, my)}


def ridge_fit(mom: dict, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """min ||y - Xw - b||^2 + alpha ||w||^2 per target (intercept free): (W d x r, b r)."""
    d = mom["G"].shape[0]
    w = np.linalg.solve(mom["G"] + alpha * np.eye(d), mom["C"])
    return w, mom["my"] - mom["mx"] @ w


def lasso_fit(mom: dict, alpha: float, max_iter: int = 2000, tol: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """min (1/2n) ||y - Xw - b||^2 + alpha ||w||_1 per target, by cyclic coordinate descent on the
    centred Gram matrix (all targets updated together, each with its own coefficients)."""
    g, c, n = mom["G"], mom["C"], mom["n"]
    d, r = c.shape
    w = np.zeros((d, r))
    diag = np.diag(g)
    thresh = alpha * n
    for _ in range(max_iter):
        biggest = 0.0
        for j in range(d):
            if diag[j] <= 0:
                continue
            rho = c[j] - g[j] @ w + diag[j] * w[j]
            new = np.sign(rho) * np.maximum(np.abs(rho) - thresh, 0.0) / diag[j]
            biggest = max(biggest, float(np.max(np.abs(new - w[j]))))
            w[j] = new
        if biggest < tol:
            break
    return w, mom["my"] - mom["mx"] @ w


def _error_rows(models: list[tuple[str, float, np.ndarray, np.ndarray]], x_col: str, y_col: str, centre):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x, y = _matrix(pdf[x_col]), _matrix(pdf[y_col])
            moved = y - centre
            frames = []
            for name, alpha, w, b in models:
                res = y - (x @ w + b)
                frames.append(pd.DataFrame({
                    "model": name, "alpha": alpha, "pos": np.arange(y.shape[1], dtype="int32"),
                    "ss_res": (res ** 2).sum(0), "sy": moved.sum(0), "syy": (moved ** 2).sum(0), "n": len(y),
                }))
            yield pd.concat(frames, ignore_index=True)

    return run


def evaluate_linear(holdout: DataFrame, models: list[tuple[str, float, np.ndarray, np.ndarray]],
                    x_col: str = "x", y_col: str = "features", centre=0.0) -> DataFrame:
    """(model, alpha, mse, rmse, r2) on the holdout; ``centre`` (the train means) keeps the sums for R2 small. The weights travel in the task closure:
    their size is models x features x factors."""
    schema = "model string, alpha double, pos int, ss_res double, sy double, syy double, n long"
    parts = holdout.select(x_col, y_col).mapInPandas(_error_rows(models, x_col, y_col, centre), schema)
    per_pos = parts.groupBy("model", "alpha", "pos").agg(
        F.sum("ss_res").alias("ss_res"), F.sum("sy").alias("sy"), F.sum("syy").alias("syy"), F.sum("n").alias("n"))
    r2 = r2_score(F.col("ss_res"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"), F.col("syy"))
    return per_pos.groupBy("model", "alpha").agg(
        F.round(F.sum("ss_res") / F.sum("n"), 6).alias("mse"),
        F.round(F.sqrt(F.sum("ss_res") / F.sum("n")), 6).alias("rmse"),
        F.round(F.avg(r2), 6).alias("r2"),
    )


def linear_grid(scaled: Scaled, alphas: list[float], kinds: tuple[str, ...] = ("ridge", "lasso"), lasso_iter: int = 2000) -> DataFrame:
    """Fit ridge and/or lasso for every alpha and score them on the holdout."""
    stats, _, models = linear.fit_grid(scaled, alphas, kinds, lasso_iter)
    return linear.evaluate(scaled.holdout, stats, models)
