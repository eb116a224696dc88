"""Registered queries: cold-start training table, split, scaling, 1-NN, patched factors, linear grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.keys import hash_id
from playlens.operators import coldstart, features, linear, metrics, recommend, sparse
from playlens.operators.neighbours import nearest_sparse
from playlens.plans.feature_queries import FEATURE_CTES, sparse_rows
from playlens.plans.oracle import murmur3_bigint, seeded_unit_bigint, with_fixtures
from playlens.plans.rec_queries import TOP_N, metrics_sql
from playlens.plans.registry import query
from playlens.sources import fixtures as fx

# Fixed values of the evaluated regressions: alphas logspace(-3, 2, 6), lasso iteration cap.
ALPHAS = [10.0 ** e for e in range(-3, 3)]
LASSO_MAX_ITER = 2000
FACTOR_HEAD = 3                              # leading factor columns shown wide

COLD_CTES = FEATURE_CTES + [
    ("keep_idx", "SELECT term, CAST(ROW_NUMBER() OVER (ORDER BY term) AS INTEGER) AS idx FROM keep_terms"),
    ("xl", """
        SELECT track_id, 0 AS pos, COALESCE(duration, 0.0) AS value FROM songs
        UNION ALL SELECT track_id, 1, artist_familiarity FROM songs
        UNION ALL SELECT track_id, 2, artist_hotttnesss FROM songs
        UNION ALL SELECT track_id, 3, CAST(year AS DOUBLE) FROM songs
        UNION ALL SELECT s.track_id, 3 + k.idx, CASE WHEN t.term IS NULL THEN 0.0 ELSE 1.0 END
        FROM songs s CROSS JOIN keep_idx k LEFT JOIN top2 t ON t.artist_id = s.artist_id AND t.term = k.term"""),
    ("tt", "SELECT v.id, s.track_id, v.features FROM item_factors v JOIN songs s ON v.id = s.track_id"),
    ("sp", f"SELECT id, track_id, features, {seeded_unit_bigint('id', coldstart.SPLIT_SEED)} < 0.8 AS is_train FROM tt"),
    ("xs", "SELECT sp.id, sp.is_train, xl.pos, xl.value FROM sp JOIN xl ON xl.track_id = sp.track_id"),
    ("mom", "SELECT pos, AVG(value) AS mu, STDDEV_POP(value) AS sd FROM xs WHERE is_train GROUP BY pos"),
    ("sc", """SELECT xs.id, xs.is_train, xs.pos, (xs.value - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS z
              FROM xs JOIN mom USING (pos)"""),
    ("dist", """SELECT q.id AS qid, r.id AS rid, SQRT(SUM((q.z - r.z) * (q.z - r.z))) AS dist
                FROM sc q JOIN sc r ON q.pos = r.pos WHERE NOT q.is_train AND r.is_train GROUP BY q.id, r.id"""),
    ("nn", """SELECT qid AS id, rid AS neighbor_id, dist FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY ROUND(dist, 9), rid) AS rn FROM dist) d
              WHERE rn = 1"""),
    ("patched", """SELECT id, features FROM sp WHERE is_train
                   UNION ALL SELECT nn.id, sp.features FROM nn JOIN sp ON sp.id = nn.neighbor_id"""),
    ("cells", """SELECT nn.id, generate_subscripts(t.features, 1) AS pos,
                        CAST(unnest(t.features) AS DOUBLE) AS y, CAST(unnest(p.features) AS DOUBLE) AS p
                 FROM nn JOIN sp t ON t.id = nn.id JOIN sp p ON p.id = nn.neighbor_id"""),
    ("per_pos", """SELECT pos, SUM((y - p) * (y - p)) AS ss_res, SUM((y - m) * (y - m)) AS ss_tot, COUNT(*) AS n
                   FROM (SELECT *, AVG(y) OVER (PARTITION BY pos) AS m FROM cells) c GROUP BY pos"""),
]


def _inputs(spark, sf_dir):
    """(factors, item dictionary, sparse rows, term dictionary)"""
    rows, terms = sparse_rows(spark, sf_dir)
    return fx.item_factors(spark, sf_dir), coldstart.identity_dictionary(fx.songs(spark, sf_dir)), rows, terms


def _table(spark, sf_dir):
    factors, dictionary, rows, _ = _inputs(spark, sf_dir)
    return coldstart.training_table(factors, dictionary, sparse.filled(rows))


def _prepared(spark, sf_dir):
    return coldstart.prepare(*_inputs(spark, sf_dir))


@query("coldstart_training", with_fixtures("""
    SELECT tt.id, tt.track_id, COALESCE(s.duration, 0.0) AS duration, s.year,
           (SELECT COUNT(*) FROM top2 t JOIN keep_terms k ON t.term = k.term WHERE t.artist_id = s.artist_id) AS n_terms
    FROM tt JOIN songs s ON s.track_id = tt.track_id""", COLD_CTES))
def coldstart_training(spark, sf_dir):
    table = coldstart.dedup_by_id(_table(spark, sf_dir))
    return table.select("id", "track_id", F.col("nums")[0].alias("duration"), F.col("nums")[3].cast("int").alias("year"),
                        F.size("terms").cast("bigint").alias("n_terms"))


@query("holdout_split", with_fixtures("SELECT id, is_train FROM sp", COLD_CTES))
def holdout_split(spark, sf_dir):
    return _table(spark, sf_dir).select("id", coldstart.in_train("id").alias("is_train"))


@query("holdout_split_exact", with_fixtures(f"""
    SELECT id, ROW_NUMBER() OVER (ORDER BY {seeded_unit_bigint('id', coldstart.SPLIT_SEED)}, id) <= FLOOR(0.8 * COUNT(*) OVER () + 0.5) AS is_train
    FROM tt""", COLD_CTES))
def holdout_split_exact(spark, sf_dir):
    """The split with exactly 80 % of the rows in train."""
    train, holdout = coldstart.exact_split(coldstart.dedup_by_id(_table(spark, sf_dir)).select("id"))
    return train.withColumn("is_train", F.lit(True)).unionByName(holdout.withColumn("is_train", F.lit(False)))


@query("holdout_split_sizes", with_fixtures("""
    SELECT COUNT(*) AS n_rows, CAST(FLOOR(0.8 * COUNT(*) + 0.5) AS BIGINT) AS n_train FROM tt""", COLD_CTES))
def holdout_split_sizes(spark, sf_dir):
    return holdout_split_exact(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("is_train"), 1)).alias("n_train"))


HASH_SLOTS = 1024  # hash ids are cut to so few values that tracks collide
_SLOT = f"((({murmur3_bigint('track_id')}) % {HASH_SLOTS} + {HASH_SLOTS}) % {HASH_SLOTS})"


def _hashed_dictionary(spark, sf_dir):
    songs = fx.songs(spark, sf_dir).select("track_id")
    return songs.select("track_id", F.pmod(hash_id("track_id"), F.lit(HASH_SLOTS)).cast("bigint").alias("item_id"))


@query("hash_chains", with_fixtures(f"""
    SELECT item_id, COUNT(*) AS n_tracks, MIN(track_id) AS track_id, STRING_AGG(CAST(track_id AS VARCHAR), ',' ORDER BY track_id) AS chain
    FROM (SELECT DISTINCT track_id, CAST({_SLOT} AS BIGINT) AS item_id FROM songs) h GROUP BY item_id"""))
def hash_chains(spark, sf_dir):
    """The tracks behind each hash id, with collisions forced by a narrow hash."""
    return coldstart.collision_chains(_hashed_dictionary(spark, sf_dir)).withColumn("chain", F.array_join("chain", ","))


@query("coldstart_training_hashed", with_fixtures(f"""
    SELECT id, track_id, n_tracks, duration, n_terms FROM (
        SELECT v.id, h.track_id, COUNT(*) OVER (PARTITION BY v.id) AS n_tracks, COALESCE(s.duration, 0.0) AS duration,
               (SELECT COUNT(*) FROM top2 t JOIN keep_terms k ON t.term = k.term WHERE t.artist_id = s.artist_id) AS n_terms,
               ROW_NUMBER() OVER (PARTITION BY v.id ORDER BY h.track_id) AS r
        FROM item_factors v JOIN (SELECT DISTINCT track_id, CAST({_SLOT} AS BIGINT) AS item_id FROM songs) h ON v.id = h.item_id
        JOIN songs s ON s.track_id = h.track_id) x
    WHERE r = 1""", FEATURE_CTES))
def coldstart_training_hashed(spark, sf_dir):
    """V joined to the item dictionary on hash ids that collide; of the tracks of one id the least survives."""
    rows, _ = sparse_rows(spark, sf_dir)
    table = coldstart.hashed_training_table(fx.item_factors(spark, sf_dir), _hashed_dictionary(spark, sf_dir), sparse.filled(rows))
    return table.select("id", "track_id", "n_tracks", F.col("nums")[0].alias("duration"), F.size("terms").cast("bigint").alias("n_terms"))


@query("scaled_features", with_fixtures(
    "SELECT id, CAST(pos AS INTEGER) AS pos, ROUND(z, 6) AS z FROM sc", COLD_CTES))
def scaled_features(spark, sf_dir):
    factors, dictionary, rows, terms = _inputs(spark, sf_dir)
    scaled = coldstart.prepare(factors, dictionary, rows, terms)
    return sparse.scaled_cells(scaled, scaled.train.unionByName(scaled.holdout), terms).withColumn("z", F.round("z", 6))


@query("knn_factors", with_fixtures("SELECT id, neighbor_id, ROUND(dist, 6) AS dist FROM nn", COLD_CTES))
def knn_factors(spark, sf_dir):
    return coldstart.knn_predict(_prepared(spark, sf_dir)).select("id", "neighbor_id", F.round("dist", 6).alias("dist"))


TIED_CTES = FEATURE_CTES + [
    ("tied_in", f"SELECT track_id AS id, artist_id, CAST(year AS DOUBLE) AS year, {seeded_unit_bigint('track_id', coldstart.SPLIT_SEED)} < 0.8 AS is_train FROM songs"),
    ("tied_x", """SELECT id, is_train, '' AS pos, year AS value FROM tied_in
                  UNION ALL SELECT s.id, s.is_train, k.term, CASE WHEN t.term IS NULL THEN 0.0 ELSE 1.0 END
                  FROM tied_in s CROSS JOIN keep_terms k LEFT JOIN top2 t ON t.artist_id = s.artist_id AND t.term = k.term"""),
    ("tied_mom", "SELECT pos, AVG(value) AS mu, STDDEV_POP(value) AS sd FROM tied_x WHERE is_train GROUP BY pos"),
    ("tied_z", "SELECT id, is_train, pos, (value - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS z FROM tied_x JOIN tied_mom USING (pos)"),
    ("tied_v", "SELECT id, is_train, LIST(z ORDER BY pos) AS v FROM tied_z GROUP BY id, is_train"),
    ("tied_q", "SELECT v, MIN(id) AS q FROM tied_v WHERE NOT is_train GROUP BY v"),
    ("tied_r", "SELECT v, MIN(id) AS r FROM tied_v WHERE is_train GROUP BY v"),
    ("tied_d", "SELECT q.v, r.r, ROUND(LIST_DISTANCE(q.v, r.v), 9) AS dist FROM tied_q q CROSS JOIN tied_r r"),
    ("tied_nn", "SELECT v, r, dist FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY v ORDER BY dist, r) AS k FROM tied_d) d WHERE k = 1"),
]


@query("knn_tied", with_fixtures(
    "SELECT x.id, n.r AS neighbor_id, ROUND(n.dist, 6) AS dist FROM tied_v x JOIN tied_nn n ON x.v = n.v WHERE NOT x.is_train", TIED_CTES))
def knn_tied(spark, sf_dir):
    """1-NN of all songs on year and terms alone, where many rows are equal: ties go to the least id."""
    songs = fx.songs(spark, sf_dir)
    top = features.artist_top_terms(fx.artist_term(spark, sf_dir), 2)
    terms = sparse.term_dictionary(top)
    rows = sparse.filled(sparse.sparse_features(songs, top, terms, ["year"])).withColumnRenamed("track_id", "id")
    scaled = sparse.standardise(rows, coldstart.in_train("id"), terms, width=1)
    found = nearest_sparse(scaled.holdout, scaled.train, scaled.terms, scaled.width)
    return found.select(F.col("query_id").alias("id"), F.col("ref_id").alias("neighbor_id"), F.round("dist", 6).alias("dist"))


@query("patched_factors", with_fixtures("""
    SELECT id, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS pos, CAST(unnest(features) AS DOUBLE) AS value
    FROM patched""", COLD_CTES))
def patched_factors(spark, sf_dir):
    scaled = _prepared(spark, sf_dir)
    v_new = coldstart.patched_factors(scaled.train, coldstart.knn_predict(scaled))
    return v_new.select("id", F.posexplode("features").alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double"))


COLD_TOPK_SQL = f"""
    SELECT user_id, rank, item_id, ROUND(score, 6) AS score FROM (
        SELECT user_id, item_id, score,
               CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
        FROM (SELECT u.id AS user_id, i.id AS item_id,
                     list_inner_product(CAST(u.features AS DOUBLE[]), CAST(i.features AS DOUBLE[])) AS score
              FROM user_factors u JOIN patched i ON u.id IN (SELECT id FROM val_users)) p) s
    WHERE rank <= {TOP_N}"""


def _patched_topk(spark, sf_dir):
    scaled = _prepared(spark, sf_dir)
    items = coldstart.patched_factors(scaled.train, coldstart.knn_predict(scaled))
    users = fx.user_factors(spark, sf_dir).join(fx.val_users(spark, sf_dir), "id", "left_semi")
    return recommend.top_k_scores(users, items, TOP_N)


@query("coldstart_topk", with_fixtures(COLD_TOPK_SQL, COLD_CTES))
def coldstart_topk(spark, sf_dir):
    """Top 500 items per validation user from the patched factors; copies of factors tie, lower id first."""
    return _patched_topk(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("topk_eval", metrics_sql("SELECT user_id, rank, item_id AS track_id FROM cold_topk", "SELECT user_id, track_id FROM val", "*",
                                (*COLD_CTES, ("cold_topk", COLD_TOPK_SQL))))
def topk_eval(spark, sf_dir):
    """MAP, P@15 and NDCG@10 of those per-user lists against the validation rows."""
    recs = _patched_topk(spark, sf_dir).withColumnRenamed("item_id", "track_id")
    truth = fx.val(spark, sf_dir).select("user_id", "track_id").distinct()
    return metrics.ranking_metrics(recs, truth, "user_id", "track_id", "rank")


@query("knn_mse", with_fixtures(
    "SELECT ROUND(SUM(ss_res) / SUM(n), 6) AS mse, ROUND(SQRT(SUM(ss_res) / SUM(n)), 6) AS rmse FROM per_pos", COLD_CTES))
def knn_mse(spark, sf_dir):
    return coldstart.knn_errors(coldstart.knn_predict(_prepared(spark, sf_dir))).select("mse", "rmse")


@query("knn_r2", with_fixtures("""
    SELECT ROUND(AVG(CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END), 6) AS r2
    FROM per_pos""", COLD_CTES))
def knn_r2(spark, sf_dir):
    return coldstart.knn_errors(coldstart.knn_predict(_prepared(spark, sf_dir))).select("r2")


@query("gram_matrix", with_fixtures("""
    SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j, ROUND(SUM(a.z * b.z), 6) AS value
    FROM sc a JOIN sc b ON a.id = b.id AND a.is_train AND b.is_train
    GROUP BY a.pos, b.pos""", COLD_CTES))
def gram_matrix(spark, sf_dir):
    """X'X of the standardised train features, from sums over the entries of the sparse rows."""
    return sparse.gram_cells(_prepared(spark, sf_dir)).select("i", "j", F.round("value", 6).alias("value"))


@query("ridge_grid")
def ridge_grid(spark, sf_dir):
    """Ridge for alpha in logspace(-3, 2, 6): holdout MSE, RMSE, R2."""
    return coldstart.linear_grid(_prepared(spark, sf_dir), ALPHAS, ("ridge",))


@query("lasso_grid")
def lasso_grid(spark, sf_dir):
    """Lasso for alpha in logspace(-3, 2, 6), max_iter 2000: holdout MSE, RMSE, R2."""
    return coldstart.linear_grid(_prepared(spark, sf_dir), ALPHAS, ("lasso",), LASSO_MAX_ITER)


def _residuals(spark, sf_dir, kind, residual):
    scaled = _prepared(spark, sf_dir)
    stats, b, models = linear.fit_grid(scaled, ALPHAS, (kind,), LASSO_MAX_ITER)
    rows = [(alpha, round(residual(scaled, stats, b, w, alpha), 6)) for _, alpha, w, _ in models]
    return spark.createDataFrame(rows, "alpha double, residual double")


RESIDUAL_SQL = "SELECT alpha, CAST(0 AS DOUBLE) AS residual FROM (VALUES " + ", ".join(f"(CAST({a} AS DOUBLE))" for a in ALPHAS) + ") v(alpha)"


@query("ridge_residuals", RESIDUAL_SQL)
def ridge_residuals(spark, sf_dir):
    """Per alpha how far the normal equations are from holding, as a share of the largest entry of Z'Y."""
    return _residuals(spark, sf_dir, "ridge", linear.ridge_residual)


@query("lasso_residuals", RESIDUAL_SQL)
def lasso_residuals(spark, sf_dir):
    """Per alpha the largest violation of the subgradient conditions, as the same share."""
    return _residuals(spark, sf_dir, "lasso", linear.lasso_residual)


ONE_FEATURE_CTES = COLD_CTES + [
    ("one_y", "SELECT id, generate_subscripts(features, 1) - 1 AS pos, CAST(unnest(features) AS DOUBLE) AS y FROM sp WHERE is_train"),
    ("one_z", "SELECT id, z FROM sc WHERE pos = 0 AND is_train"),
    ("one_m", "SELECT pos, AVG(y) AS m FROM one_y GROUP BY pos"),
    ("one_s", "SELECT pos, m, SUM(z * (y - m)) AS zy, SUM(z * z) AS zz FROM one_y JOIN one_m USING (pos) JOIN one_z USING (id) GROUP BY pos, m"),
]


@query("ridge_one_feature", with_fixtures(
    "SELECT v.alpha, CAST(pos AS INTEGER) AS pos, ROUND(zy / (zz + v.alpha), 6) AS weight, ROUND(m, 6) AS intercept FROM one_s CROSS JOIN (VALUES "
    + ", ".join(f"(CAST({a} AS DOUBLE))" for a in ALPHAS) + ") v(alpha)", ONE_FEATURE_CTES))
def ridge_one_feature(spark, sf_dir):
    """Ridge on the standardised duration alone, where the solution has a closed form."""
    full = _prepared(spark, sf_dir)
    one = [part.withColumn("nums", F.slice("nums", 1, 1)).withColumn("terms", F.array().cast("array<int>")) for part in (full.train, full.holdout)]
    scaled = sparse.Scaled(one[0], one[1], full.terms.limit(0), 1, 1)
    _, _, models = linear.fit_grid(scaled, ALPHAS, ("ridge",))
    rows = [(alpha, i, round(float(w[0, i]), 6), round(float(c[i]), 6)) for _, alpha, w, c in models for i in range(w.shape[1])]
    return spark.createDataFrame(rows, "alpha double, pos int, weight double, intercept double")


@query("factor_head_cols", with_fixtures(
    "SELECT id, " + ", ".join(f"CAST(features[{i + 1}] AS DOUBLE) AS f{i}" for i in range(FACTOR_HEAD))
    + " FROM item_factors"))
def factor_head_cols(spark, sf_dir):
    v = fx.item_factors(spark, sf_dir)
    return v.select("id", *[F.col("features")[i].cast("double").alias(f"f{i}") for i in range(FACTOR_HEAD)])


@query("factor_relist", with_fixtures("""
    SELECT id, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS pos, CAST(unnest(features) AS DOUBLE) AS value
    FROM item_factors"""))
def factor_relist(spark, sf_dir):
    """Factor list -> wide columns -> long (melt) -> list per id in position order -> rows."""
    v = fx.item_factors(spark, sf_dir)
    width = v.select(F.max(F.size("features"))).first()[0] or 0  # schema width: factor rank
    wide = v.select("id", *[F.col("features")[i].alias(f"f{i}") for i in range(width)])
    long = wide.unpivot(["id"], [f"f{i}" for i in range(width)], "variable", "value")
    long = long.withColumn("pos", F.substring("variable", 2, 10).cast("int"))
    relisted = long.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_l"))
    back = relisted.select("id", F.transform("_l", lambda s: s["value"]).alias("features"))
    return back.select("id", F.posexplode("features").alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double"))


@query("factor_dedup", with_fixtures("""
    SELECT artist_id, MIN(track_id) AS track_id, CAST(arg_min(features[1], track_id) AS DOUBLE) AS f0
    FROM (SELECT s.artist_id, s.track_id, v.features FROM item_factors v JOIN songs s ON v.id = s.track_id) j
    GROUP BY artist_id"""))
def factor_dedup(spark, sf_dir):
    """Factor rows fanned out to artists (several tracks each), one survivor per artist: lowest track."""
    songs = fx.songs(spark, sf_dir).select("track_id", "artist_id")
    joined = fx.item_factors(spark, sf_dir).join(songs, F.col("id") == F.col("track_id")).select(
        "artist_id", "track_id", "features")
    kept = coldstart.dedup_by_id(joined, "artist_id", "track_id")
    return kept.select("artist_id", "track_id", F.col("features")[0].cast("double").alias("f0"))
