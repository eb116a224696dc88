"""Registered queries: popularity baseline, ranking metrics, ALS, blocked top-k scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.keys import with_hash_ids
from playlens.functions.positions import positions
from playlens.operators import metrics, recommend
from playlens.plans.oracle import murmur3_bigint, with_fixtures
from playlens.plans.registry import query
from playlens.sources import fixtures as fx

# Fixed values of the evaluated jobs: list length, metric cut-offs, ALS grid.
TOP_N = 500          # recommendations per user
K_PRECISION = 15
K_NDCG = 10
ALS_MAX_ITER = 5     # the reference takes maxIter as a required argument
ALS_RANKS = (10, 20, 50, 100, 200)
ALS_REGS = (0.001, 0.01, 0.1, 1.0)

POPULAR_SQL = f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY diff_plays DESC, track_id) AS BIGINT) AS rank, track_id, diff_plays
    FROM (SELECT track_id, COUNT(*) AS diff_plays FROM train GROUP BY track_id
          ORDER BY diff_plays DESC, track_id LIMIT {TOP_N}) t"""


def metrics_sql(recs_sql: str, truth_sql: str, select: str, before: tuple = ()) -> str:
    """Ranking metrics in SQL: hits by join, ideal DCG from a prefix sum over 1..k; ``before``: CTEs of recs_sql."""
    ctes = [
        *before,
        ("recs", recs_sql),
        ("truth_d", f"SELECT DISTINCT user_id, track_id FROM ({truth_sql}) t"),
        ("n_truth", "SELECT user_id, COUNT(*) AS ns FROM truth_d GROUP BY user_id"),
        ("pop_users", "SELECT * FROM n_truth WHERE user_id IN (SELECT user_id FROM recs)"),
        ("hits", """SELECT r.user_id, r.rank, ROW_NUMBER() OVER (PARTITION BY r.user_id ORDER BY r.rank) AS h
                    FROM recs r JOIN truth_d t ON r.user_id = t.user_id AND r.track_id = t.track_id"""),
        ("per_user", f"""SELECT user_id, SUM(h / rank) AS ap_sum,
                        COUNT(*) FILTER (WHERE rank <= {K_PRECISION}) AS p_hits,
                        SUM(CASE WHEN rank <= {K_NDCG} THEN 1 / LOG2(rank + 1) END) AS dcg
                    FROM hits GROUP BY user_id"""),
        ("ideal", f"""SELECT i AS m, SUM(1 / LOG2(i + 1)) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS idcg
                    FROM range(1, {K_NDCG + 1}) t(i)"""),
        ("scored", f"""SELECT COALESCE(ap_sum, 0) / ns AS ap, COALESCE(p_hits, 0) / {K_PRECISION} AS prec,
                        COALESCE(dcg, 0) / idcg AS ndcg
                    FROM pop_users LEFT JOIN per_user USING (user_id)
                    JOIN ideal ON ideal.m = LEAST(pop_users.ns, {K_NDCG})"""),
        ("result", f"""SELECT COUNT(*) AS n_users, ROUND(AVG(ap), 6) AS map,
                        ROUND(AVG(prec), 6) AS precision_at_{K_PRECISION}, ROUND(AVG(ndcg), 6) AS ndcg_at_{K_NDCG}
                    FROM scored"""),
    ]
    return with_fixtures(f"SELECT {select} FROM result", ctes)


BASELINE_RECS_SQL = f"""
    SELECT u.user_id, p.rank, p.track_id FROM (SELECT DISTINCT user_id FROM val) u
    CROSS JOIN ({POPULAR_SQL}) p"""


def _baseline(spark, sf_dir):
    train, val = fx.train(spark, sf_dir), fx.val(spark, sf_dir)
    popular = recommend.popular_items(train, TOP_N)
    return metrics.shared_list_metrics(popular, val, k_precision=K_PRECISION, k_ndcg=K_NDCG, max_list=TOP_N)


@query("popular_items", with_fixtures(POPULAR_SQL))
def popular_items(spark, sf_dir):
    return recommend.popular_items(fx.train(spark, sf_dir), TOP_N)


@query("baseline_recs", with_fixtures(BASELINE_RECS_SQL))
def baseline_recs(spark, sf_dir):
    users = fx.val(spark, sf_dir).select("user_id")
    lists = recommend.popularity_recommendations(users, recommend.popular_items(fx.train(spark, sf_dir), TOP_N))
    return metrics.long_form(lists, "user_id", "recommendations").withColumnRenamed("item", "track_id")


@query("baseline_eval", metrics_sql(BASELINE_RECS_SQL, "SELECT * FROM val", "*"))
def baseline_eval(spark, sf_dir):
    return _baseline(spark, sf_dir)


@query("baseline_map", metrics_sql(BASELINE_RECS_SQL, "SELECT * FROM val", "n_users, map"))
def baseline_map(spark, sf_dir):
    return _baseline(spark, sf_dir).select("n_users", "map")


@query("baseline_precision", metrics_sql(BASELINE_RECS_SQL, "SELECT * FROM val", f"n_users, precision_at_{K_PRECISION}"))
def baseline_precision(spark, sf_dir):
    return _baseline(spark, sf_dir).select("n_users", f"precision_at_{K_PRECISION}")


@query("baseline_ndcg", metrics_sql(BASELINE_RECS_SQL, "SELECT * FROM val", f"n_users, ndcg_at_{K_NDCG}"))
def baseline_ndcg(spark, sf_dir):
    return _baseline(spark, sf_dir).select("n_users", f"ndcg_at_{K_NDCG}")


@query("user_truth", with_fixtures("""
    SELECT user_id, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY count DESC, track_id) AS BIGINT) AS pos,
           track_id, count
    FROM val"""))
def user_truth(spark, sf_dir):
    """Validation rows in list order (user asc, count desc, track asc) as explicit positions.

    Positions come from the range-partitioned numbering, so one heavy user spreads over tasks.
    """
    v = fx.val(spark, sf_dir)
    return positions(v, [F.col("count").desc(), F.col("track_id").asc()], ["user_id"], name="pos").select(
        "user_id", "pos", "track_id", "count"
    )


TOPK_SQL = f"""
    SELECT user_id, rank, item_id, ROUND(score, 6) AS score FROM (
        SELECT u.id AS user_id, i.id AS item_id,
               list_inner_product(CAST(u.features AS DOUBLE[]), CAST(i.features AS DOUBLE[])) AS score,
               CAST(ROW_NUMBER() OVER (PARTITION BY u.id ORDER BY
                    list_inner_product(CAST(u.features AS DOUBLE[]), CAST(i.features AS DOUBLE[])) DESC, i.id) AS BIGINT) AS rank
        FROM (SELECT * FROM user_factors WHERE id IN (SELECT id FROM val_users)) u CROSS JOIN item_factors i) s
    WHERE rank <= {TOP_N}"""


@query("topk_scores", with_fixtures(TOPK_SQL))
def topk_scores(spark, sf_dir):
    users = fx.user_factors(spark, sf_dir).join(fx.val_users(spark, sf_dir), "id", "left_semi")
    out = recommend.top_k_scores(users, fx.item_factors(spark, sf_dir), TOP_N)
    return out.withColumn("score", F.round("score", 6))


def _als_inputs(spark, sf_dir):
    train = with_hash_ids(fx.train(spark, sf_dir))
    val = with_hash_ids(fx.val(spark, sf_dir))
    return train, val


@query("als_factors")
def als_factors(spark, sf_dir):
    """Item factors of one implicit ALS fit (rank 10, reg 0.01): (id, pos, value) rows."""
    train, _ = _als_inputs(spark, sf_dir)
    model = recommend.fit_als(train, rank=10, reg=0.01, max_iter=ALS_MAX_ITER)
    return model.itemFactors.select("id", F.posexplode("features").alias("pos", "value"))


@query("als_factor_index", with_fixtures(f"""
    SELECT id, CAST(pos AS INTEGER) AS pos
    FROM (SELECT DISTINCT {murmur3_bigint('track_id')} AS id FROM train) t CROSS JOIN range(0, 10) r(pos)"""))
def als_factor_index(spark, sf_dir):
    """The factor cells a fit must give: one per trained item and factor."""
    return als_factors(spark, sf_dir).where("value is not null").select("id", "pos")


def _als_model(spark, sf_dir):
    """The fit that the recommendation queries share, and the validation rows."""
    train, val = _als_inputs(spark, sf_dir)
    return recommend.fit_als(train, rank=10, reg=0.01, max_iter=ALS_MAX_ITER), val


@query("als_rec_lengths", with_fixtures(f"""
    SELECT {murmur3_bigint('user_id')} AS user_hashId, LEAST({TOP_N}, (SELECT COUNT(DISTINCT track_id) FROM train)) AS n_items
    FROM (SELECT DISTINCT user_id FROM val WHERE user_id IN (SELECT user_id FROM train)) u"""))
def als_rec_lengths(spark, sf_dir):
    """Users with recommendations and how many distinct items each gets."""
    model, val = _als_model(spark, sf_dir)
    lists = recommend.als_lists(model, val, TOP_N)
    return lists.select("user_hashId", F.size(F.array_distinct("items")).cast("bigint").alias("n_items"))


@query("val_user_factors", with_fixtures("""
    SELECT id, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS pos, CAST(unnest(features) AS DOUBLE) AS value
    FROM user_factors WHERE id IN (SELECT id FROM val_users)"""))
def val_user_factors(spark, sf_dir):
    """Factors of the users on the validation list, as cells."""
    users = fx.user_factors(spark, sf_dir).join(fx.val_users(spark, sf_dir), "id", "left_semi")
    return users.select("id", F.posexplode("features").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


@query("als_rec_ids")
def als_rec_ids(spark, sf_dir):
    """Top-500 ALS recommendations for the validation users, long form."""
    model, val = _als_model(spark, sf_dir)
    return recommend.als_recommendations(model, val, TOP_N)


GRID_CHECK = ((2, 4), (0.1, 1.0))  # ranks and regs of the structural check


@query("als_grid_settings", with_fixtures(f"""
    SELECT CAST(r.rank AS INTEGER) AS rank, CAST(g.reg AS DOUBLE) AS reg, n_users
    FROM (VALUES {", ".join(f"({r})" for r in GRID_CHECK[0])}) r(rank), (VALUES {", ".join(f"({g})" for g in GRID_CHECK[1])}) g(reg),
         (SELECT COUNT(DISTINCT user_id) AS n_users FROM val WHERE user_id IN (SELECT user_id FROM train)) u"""))
def als_grid_settings(spark, sf_dir):
    """A row per setting, scored on all validation users that were trained, with metrics in range."""
    train, val = _als_inputs(spark, sf_dir)
    grid = recommend.als_grid(train, val, *GRID_CHECK, 2, TOP_N)
    scored = [F.col(c).between(0, 1) for c in ("map", f"precision_at_{K_PRECISION}", f"ndcg_at_{K_NDCG}")]
    return grid.where(scored[0] & scored[1] & scored[2]).select("rank", "reg", "n_users")


@query("als_grid")
def als_grid(spark, sf_dir):
    """MAP, P@15, NDCG@10 for ranks {10,20,50,100,200} x regs {0.001,0.01,0.1,1}."""
    train, val = _als_inputs(spark, sf_dir)
    return recommend.als_grid(train, val, ALS_RANKS, ALS_REGS, ALS_MAX_ITER, TOP_N)
