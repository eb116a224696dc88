"""Metadata features: term popularity per artist, top terms, tag and lyric tables.

Multi-hot item features are sparse rows over a term dictionary: see ``sparse.py``.

"Top terms per artist" uses ``rank() OVER (PARTITION BY artist ORDER BY term_count DESC) <= n``.
Spark plans this with a WindowGroupLimit before and after the shuffle, so a prolific artist sends
only its per-task top rows (ties included) to one task, not all its term rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.skew import join_unique

NUMERIC_SONG_FEATURES = ["duration", "artist_familiarity", "artist_hotttnesss", "year"]


def term_counts(artist_term: DataFrame) -> DataFrame:
    """(term, term_count): number of artist rows carrying the term."""
    return artist_term.groupBy("term").agg(F.count("artist_id").alias("term_count"))


def artist_term_counts(artist_term: DataFrame) -> DataFrame:
    """(artist_id, term, term_count): each artist term with the term's overall popularity.

    The per-term table has one row per vocabulary term. Rows of the most frequent terms are not shuffled by
    term: at most ``MAX_HEAVY`` terms have so many, and their counts are broadcast.
    """
    return join_unique(artist_term, term_counts(artist_term), "term", "term_count").select("artist_id", "term", "term_count")


def artist_max_term(artist_term: DataFrame) -> DataFrame:
    """(artist_id, max_tc): count of the artist's most popular term."""
    return artist_term_counts(artist_term).groupBy("artist_id").agg(F.max("term_count").alias("max_tc"))


def artist_top_terms(artist_term: DataFrame, top: int = 1) -> DataFrame:
    """(artist_id, term, term_count, rank) with ``rank() <= top``: ties are all kept."""
    w = Window.partitionBy("artist_id").orderBy(F.col("term_count").desc())
    ranked = artist_term_counts(artist_term).withColumn("rank", F.rank().over(w))
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint"))


def artist_top_term_strict(artist_term: DataFrame) -> DataFrame:
    """One term per artist: most popular, ties broken by term name (the stated intent)."""
    w = Window.partitionBy("artist_id").orderBy(F.col("term_count").desc(), F.col("term").asc())
    return artist_term_counts(artist_term).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def term_retention(artist_term: DataFrame) -> DataFrame:
    """Rows kept by the max-count rule vs distinct artists (they differ when top terms tie)."""
    kept = artist_top_terms(artist_term, 1).agg(F.count("*").alias("n_rows_kept"))
    artists = artist_term.agg(F.countDistinct("artist_id")).scalar()
    return kept.select("n_rows_kept", artists.alias("n_artists"))


def term_long_tail(top_terms: DataFrame) -> DataFrame:
    """(term, n_artists) of the retained terms: the long tail of terms."""
    return top_terms.groupBy("term").agg(F.count("artist_id").alias("n_artists"))


def artist_term_map(top_terms: DataFrame, as_map: bool = False) -> DataFrame:
    """Term -> count per artist: rows (artist_id, term, n), or one map column per artist."""
    rows = top_terms.groupBy("artist_id", "term").agg(F.count("*").alias("n"))
    if not as_map:
        return rows
    return rows.groupBy("artist_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "n"))).alias("term_counts"))


def null_term_share(songs: DataFrame, top_terms: DataFrame) -> DataFrame:
    """Songs, songs whose artist has no term, their share, and the first such song (lowest id)."""
    artists = top_terms.select("artist_id").distinct().withColumn("_has", F.lit(True))
    flagged = songs.join(artists, "artist_id", "left").withColumn("_null", F.col("_has").isNull())
    return flagged.agg(
        F.count("*").alias("n_songs"),
        F.count(F.when(F.col("_null"), 1)).alias("n_null"),
        F.round(F.avg(F.col("_null").cast("int")), 6).alias("null_share"),
        F.min(F.when(F.col("_null"), F.col("track_id"))).alias("first_null_track"),
    )


def rows_for_value(df: DataFrame, col: str, value) -> DataFrame:
    """Equality lookup (pushed down to the scan when ``df`` is a file source)."""
    return df.filter(F.col(col) == value)


def track_tags(tids: DataFrame, tid_tag: DataFrame, tags: DataFrame) -> DataFrame:
    """Bridge join tids - tid_tag - tags on explicit keys: (tid, tag, val)."""
    return tids.join(tid_tag, "tid_key").join(tags, "tag_key").select("tid", "tag", "val")


def distinct_words(lyrics: DataFrame) -> DataFrame:
    """(track_id, numwords): distinct words per track; (track, word) pairs are deduped map-side."""
    return lyrics.groupBy("track_id").agg(F.countDistinct("word").alias("numwords"))
