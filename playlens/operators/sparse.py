"""Sparse item features: a term dictionary, sparse rows, and standardisation that never writes dense rows.

A song's features are a few numbers and the terms of its artist. A row keeps the numbers as an array and the
terms as the sorted positions of those it has; a term's position comes from a dictionary table that Spark
numbers in term order. The vocabulary is never collected and never becomes columns, so any number of terms
and any name works.

Standardising moves a 0/1 column j to (x - mu_j) / s_j. Two rows then differ by 1 / s_j where one of them has
the term and by nothing where both or neither do, so the rows stay sparse and only (mu_j, s_j) is kept,
one row per term that occurs in training; other terms have mu 0 and s 1. Cells of the dense table appear only
where a query asks for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.lineage import kept
from playlens.functions.positions import positions
from playlens.operators.features import NUMERIC_SONG_FEATURES

CELL_BLOCK = 1024  # terms per dictionary block where dense cells are asked for


def term_dictionary(top_terms: DataFrame, drop_level: str | None = None) -> DataFrame:
    """(term, idx): the distinct terms numbered from 0 in term order, without the reference level.

    The reference level defaults to the last term. ``drop_level=""`` keeps all but an empty term.
    """
    terms = top_terms.select("term").where(F.col("term").isNotNull()).distinct()
    level = F.lit(drop_level) if drop_level is not None else terms.agg(F.max("term")).scalar()
    return positions(terms.where(F.col("term") != level), ["term"], name="idx").select("term", (F.col("idx") - 1).cast("int").alias("idx"))


def artist_term_rows(top_terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(artist_id, terms): sorted positions of each artist's terms, empty if it has the reference level only."""
    return top_terms.join(dictionary, "term", "left").groupBy("artist_id").agg(F.array_sort(F.collect_set("idx")).alias("terms"))


def sparse_features(songs: DataFrame, top_terms: DataFrame, dictionary: DataFrame,
                    numeric: list[str] = NUMERIC_SONG_FEATURES) -> DataFrame:
    """(track_id, nums, terms) per song; ``terms`` is null for a song whose artist has no term (left join)."""
    nums = F.array(*[F.col(f"`{c}`").cast("double") for c in numeric])
    return songs.join(artist_term_rows(top_terms, dictionary), "artist_id", "left").select("track_id", nums.alias("nums"), "terms")


def filled(rows: DataFrame) -> DataFrame:
    """Nulls as 0: numbers that are missing, and the terms of songs without any."""
    return rows.withColumn("nums", F.transform("nums", lambda v: F.coalesce(v, F.lit(0.0)))).withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<int>")))


def _blocks(dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """(block, entries): CELL_BLOCK dictionary rows as one array, in order of idx."""
    return dictionary.groupBy((F.col("idx") / CELL_BLOCK).cast("int").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("idx", *columns))).alias("entries"))


def term_cells(rows: DataFrame, keys: list[str], dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """keys, idx, ``columns`` of the dictionary and ``has``: one row per input row and term.

    Every row meets every block of the dictionary by an equi-join on the block number (broadcast if Spark
    measures the blocks as small); ``has`` is null where ``terms`` is.
    """
    n_blocks = dictionary.agg(F.max("idx")).first()[0]
    blocks = F.sequence(F.lit(0), F.lit((n_blocks or 0) // CELL_BLOCK))
    met = rows.select(*keys, "terms", F.explode(blocks).alias("block")).join(_blocks(dictionary, columns), "block")
    cell = met.select(*keys, "terms", F.explode("entries").alias("e"))
    return cell.select(*keys, "e.*", F.array_contains("terms", F.col("e.idx")).alias("has"))


def long_cells(rows: DataFrame, dictionary: DataFrame, numeric: list[str] = NUMERIC_SONG_FEATURES) -> DataFrame:
    """(track_id, feature, value) of the whole table as the wide one would have it, nulls kept."""
    names = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("nums")[i].alias("value")) for i, c in enumerate(numeric)])
    numbers = rows.select("track_id", F.explode(names).alias("c")).select("track_id", "c.feature", "c.value")
    terms = term_cells(rows, ["track_id"], dictionary, ["term"])
    return numbers.unionByName(terms.select("track_id", F.col("term").alias("feature"), F.col("has").cast("double").alias("value")))


# --------------------------------------------------------------------------------------------
# Standardisation


@dataclass
class Scaled:
    """Standardised numbers and sparse terms of training and holdout rows, with the terms' statistics.

    ``train`` and ``holdout`` are (id, track_id, features, nums, terms); ``terms`` is (idx, mu, scale) for the
    terms of training rows; ``width`` is the count of numbers and ``size`` that of all columns.
    """

    train: DataFrame
    holdout: DataFrame
    terms: DataFrame
    width: int
    size: int


def number_stats(train: DataFrame, width: int) -> DataFrame:
    """One row: mean and scale (population std, 1 when 0) of each number."""
    parts = train.agg(*[F.avg(F.col("nums")[i]).alias(f"m{i}") for i in range(width)],
                      *[F.stddev_pop(F.col("nums")[i]).alias(f"s{i}") for i in range(width)])
    return parts.select(
        F.array(*[F.col(f"m{i}") for i in range(width)]).alias("mean"),
        F.array(*[F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")) for i in range(width)]).alias("scale"))


def term_stats(train: DataFrame) -> DataFrame:
    """(idx, mu, scale) of the terms that occur: from their counts alone (population std, 1 when 0)."""
    n = train.agg(F.count("*")).scalar()
    counts = train.select(F.explode("terms").alias("idx")).groupBy("idx").agg(F.count("*").alias("c"))
    share = counts.select("idx", (F.col("c") / n).alias("mu"))
    spread = F.sqrt(F.col("mu") * (1 - F.col("mu")))
    return share.select("idx", "mu", F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias("scale"))


def standardise(table: DataFrame, in_train: Column, dictionary: DataFrame, width: int = len(NUMERIC_SONG_FEATURES)) -> Scaled:
    """Standardise with the statistics of the rows that ``in_train`` flags."""
    table = table.withColumn("_train", in_train)
    stats = number_stats(table.filter("_train"), width)
    z = F.transform(F.col("nums"), lambda v, i: (v - F.col("_st.mean")[i]) / F.col("_st.scale")[i])
    rows = kept(table.withColumn("_st", stats.select(F.struct("mean", "scale")).scalar()).withColumn("nums", z).drop("_st"))
    train = rows.filter("_train").drop("_train")
    terms = kept(term_stats(train))
    size = width + dictionary.count()
    return Scaled(train, rows.filter(~F.col("_train")).drop("_train"), terms, width, size)


def scaled_cells(scaled: Scaled, rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(id, pos, z): the dense cells of ``rows``, for a query that asks for them."""
    stats = dictionary.join(scaled.terms, "idx", "left").select(
        "idx", F.coalesce("mu", F.lit(0.0)).alias("mu"), F.coalesce("scale", F.lit(1.0)).alias("scale"))
    numbers = rows.select("id", F.posexplode("nums").alias("pos", "z"))
    cells = term_cells(rows, ["id"], stats, ["mu", "scale"])
    return numbers.unionByName(cells.select(
        "id", (F.col("idx") + scaled.width).cast("int").alias("pos"), ((F.col("has").cast("double") - F.col("mu")) / F.col("scale")).alias("z")))


def gram_cells(scaled: Scaled) -> DataFrame:
    """(i, j, value): X'X of the standardised training rows, from sums over the entries that rows have.

    A row adds only the products of its own entries (its numbers, and 1 for each term); centring and
    scaling follow on the sums: (sum x_i x_j - n mu_i mu_j) / (s_i s_j), with the numbers centred already.
    """
    train, width = scaled.train, scaled.width
    n = train.agg(F.count("*")).scalar()
    entries = F.concat(F.transform("nums", lambda v, i: F.struct(i.alias("pos"), v.alias("v"))),
                       F.transform("terms", lambda t: F.struct((t + width).alias("pos"), F.lit(1.0).alias("v"))))
    rows = train.select(entries.alias("e")).select("e", F.explode("e").alias("a")).select("a", F.explode("e").alias("b"))
    sums = rows.groupBy(F.col("a.pos").alias("i"), F.col("b.pos").alias("j")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("raw"))
    stats = scaled.terms.select((F.col("idx") + width).alias("pos"), "mu", "scale")
    spark = train.sparkSession
    every = spark.range(scaled.size).select(F.col("id").cast("int").alias("pos")).join(stats, "pos", "left").select(
        "pos", F.coalesce("mu", F.lit(0.0)).alias("mu"), F.coalesce("scale", F.lit(1.0)).alias("scale"))
    # All columns against all columns is what the result is.
    left = every.select(F.col("pos").alias("i"), F.col("mu").alias("mi"), F.col("scale").alias("si"),
                        F.explode(F.sequence(F.lit(0), F.lit(max(scaled.size - 1, 0)))).alias("j"))
    grid = left.join(every.select(F.col("pos").alias("j"), F.col("mu").alias("mj"), F.col("scale").alias("sj")), "j")
    value = (F.coalesce("raw", F.lit(0.0)) - n * F.col("mi") * F.col("mj")) / (F.col("si") * F.col("sj"))
    return grid.join(sums, ["i", "j"], "left").select("i", "j", value.alias("value"))
