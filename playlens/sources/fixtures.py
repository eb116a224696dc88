"""Inputs of the recommender jobs, derived from the test tables (see FIXTURES.md).

interactions / train / val   (user_id, track_id, count) from orders x lineitem
songs, artist_term           song metadata and artist terms from part
user_factors, item_factors   (id, features) factor matrices from embeddings; val_users (id)
tids, tags, tid_tag          tag tables with explicit keys
lyrics                       (track_id, word, count) from documents
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlens.sources.tables import read_table, spread

# Fixed split rules of the fixtures: which orders feed train or validation, which embedding rows
# are user or item factors, and which users count as validation users.
TRAIN_VAL_MODULUS = 5      # o_orderkey % 5 = 0 -> validation, otherwise train
FACTOR_MODULUS = 4         # vec_id % 4 = 0 -> user factors, otherwise item factors
VAL_USER_MODULUS = 8       # vec_id % 8 = 0 -> validation users
NULL_DURATION_EVERY = 97   # every 97th song has no duration
NO_TERM_BRAND = "Brand#11"  # artists of this brand have no term


def interactions(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """One row per (user, track): summed quantity of that customer's order lines for the part."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    if split is not None:
        if split not in ("train", "val"):
            raise ValueError(f"split must be 'train' or 'val', got {split!r}")

        def keep(key: Column) -> Column:
            rest = key % TRAIN_VAL_MODULUS
            return rest != 0 if split == "train" else rest == 0

        # The same predicate on both sides, so each scan is filtered before the join.
        orders = orders.filter(keep(F.col("o_orderkey")))
        lines = lines.filter(keep(F.col("l_orderkey")))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.groupBy(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("track_id")
    ).agg(F.sum("l_quantity").cast("bigint").alias("count"))


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark, sf_dir, "train")


def val(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark, sf_dir, "val")


def _artist(part: DataFrame) -> Column:
    return F.concat(part.p_brand, F.lit("/"), part.p_type)


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        key.alias("track_id"),
        _artist(part).alias("artist_id"),
        F.when(key % NULL_DURATION_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("p_retailprice"))
        .alias("duration"),
        (((key * 37) % 1000).cast("double") / 1000).alias("artist_familiarity"),
        (((key * 91) % 1000).cast("double") / 1000).alias("artist_hotttnesss"),
        (F.lit(1960) + F.col("p_size")).alias("year"),
    )


def artist_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (artist, term) of all parts; a term is null, and so left out, for one brand's artists."""
    part = read_table(spark, sf_dir, "part")
    term = F.when(F.col("p_brand") != NO_TERM_BRAND, F.col("p_name"))
    return part.select(_artist(part).alias("artist_id"), term.alias("term")).where("term is not null").distinct()


def _factors(spark: SparkSession, sf_dir: str, users: bool) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    rest = F.col("vec_id") % FACTOR_MODULUS
    return emb.filter(rest == 0 if users else rest != 0).select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir, users=True)


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir, users=False)


def val_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.filter(F.col("vec_id") % VAL_USER_MODULUS == 0).select(F.col("vec_id").alias("id")).distinct()


def tids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("tid_key"),
        F.concat(F.lit("TR"), F.col("p_partkey").cast("string")).alias("tid"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag vocabulary with a dense key. The window is global, but it runs over the distinct tag
    names only (a vocabulary, not the interaction data)."""
    names = read_table(spark, sf_dir, "part").select(F.col("p_name").alias("tag")).distinct()
    return names.select(
        F.dense_rank().over(Window.orderBy("tag")).cast("bigint").alias("tag_key"), "tag"
    )


def tid_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    vocab = tags(spark, sf_dir)
    return part.join(vocab, part.p_name == vocab.tag).select(
        F.col("p_partkey").alias("tid_key"), "tag_key", F.col("p_size").cast("double").alias("val")
    )


def lyrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per document over whole texts (split on single spaces, empty tokens dropped)."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = docs.select(F.col("doc_id").alias("track_id"), F.explode(F.split("text", " ")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("track_id", "word").agg(F.count("*").alias("count"))


FIXTURES = {
    "interactions": interactions,
    "train": train,
    "val": val,
    "songs": songs,
    "artist_term": artist_term,
    "user_factors": user_factors,
    "item_factors": item_factors,
    "val_users": val_users,
    "tids": tids,
    "tags": tags,
    "tid_tag": tid_tag,
    "lyrics": lyrics,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FIXTURES[name](spark, sf_dir)
