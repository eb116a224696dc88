"""Registered queries: artist terms, multi-hot item features, tags and lyrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.operators import features, sparse, stats
from playlens.plans.oracle import with_fixtures
from playlens.plans.registry import query
from playlens.sources import fixtures as fx

TC = ("tc", "SELECT term, COUNT(artist_id) AS term_count FROM artist_term GROUP BY term")
ATC = ("atc", "SELECT a.artist_id, a.term, tc.term_count FROM artist_term a JOIN tc ON a.term = tc.term")
RANKED = ("ranked", """SELECT artist_id, term, term_count,
        CAST(RANK() OVER (PARTITION BY artist_id ORDER BY term_count DESC) AS BIGINT) AS rank FROM atc""")
TOP1 = ("top1", "SELECT * FROM ranked WHERE rank <= 1")
TOP2 = ("top2", "SELECT * FROM ranked WHERE rank <= 2")
TERM_CTES = [TC, ATC, RANKED, TOP1, TOP2]
FEATURE_CTES = TERM_CTES + [
    ("vocab", "SELECT DISTINCT term FROM top2"),
    ("keep_terms", "SELECT term FROM vocab WHERE term <> (SELECT MAX(term) FROM vocab)"),
    ("termed", "SELECT DISTINCT artist_id FROM top2"),
]


def _top(spark, sf_dir, n):
    return features.artist_top_terms(fx.artist_term(spark, sf_dir), n)


@query("term_counts", with_fixtures("SELECT * FROM tc", [TC]))
def term_counts(spark, sf_dir):
    return features.term_counts(fx.artist_term(spark, sf_dir))


@query("artist_max_term", with_fixtures("SELECT artist_id, MAX(term_count) AS max_tc FROM atc GROUP BY artist_id", [TC, ATC]))
def artist_max_term(spark, sf_dir):
    return features.artist_max_term(fx.artist_term(spark, sf_dir))


@query("artist_top_term", with_fixtures("""
    SELECT a.artist_id, a.term, a.term_count FROM atc a
    JOIN (SELECT artist_id, MAX(term_count) AS max_tc FROM atc GROUP BY artist_id) m
      ON a.artist_id = m.artist_id AND a.term_count = m.max_tc""", [TC, ATC]))
def artist_top_term(spark, sf_dir):
    return _top(spark, sf_dir, 1).select("artist_id", "term", "term_count")


@query("artist_top2_terms", with_fixtures("SELECT * FROM top2", TERM_CTES))
def artist_top2_terms(spark, sf_dir):
    return _top(spark, sf_dir, 2)


@query("term_retention", with_fixtures("""
    SELECT (SELECT COUNT(*) FROM top1) AS n_rows_kept, (SELECT COUNT(DISTINCT artist_id) FROM artist_term) AS n_artists""",
    TERM_CTES))
def term_retention(spark, sf_dir):
    return features.term_retention(fx.artist_term(spark, sf_dir))


@query("term_long_tail", with_fixtures("SELECT term, COUNT(artist_id) AS n_artists FROM top1 GROUP BY term", TERM_CTES))
def term_long_tail(spark, sf_dir):
    return features.term_long_tail(_top(spark, sf_dir, 1))


@query("artist_term_map", with_fixtures("SELECT artist_id, term, COUNT(*) AS n FROM top2 GROUP BY artist_id, term", TERM_CTES))
def artist_term_map(spark, sf_dir):
    return features.artist_term_map(_top(spark, sf_dir, 2))


@query("artist_term_map_entries", with_fixtures(
    "SELECT artist_id, term, COUNT(*) AS n FROM top2 GROUP BY artist_id, term", TERM_CTES))
def artist_term_map_entries(spark, sf_dir):
    """The entries of the one map column per artist."""
    maps = features.artist_term_map(_top(spark, sf_dir, 2), as_map=True)
    return maps.select("artist_id", F.explode("term_counts").alias("term", "n"))


@query("artist_multihot", with_fixtures("""
    SELECT a.artist_id, v.term, COUNT(t.term) AS value
    FROM termed a CROSS JOIN vocab v LEFT JOIN top2 t ON t.artist_id = a.artist_id AND t.term = v.term
    GROUP BY a.artist_id, v.term""", FEATURE_CTES))
def artist_multihot(spark, sf_dir):
    """Every artist against every term, from sparse rows over the whole dictionary."""
    top = _top(spark, sf_dir, 2)
    dictionary = sparse.term_dictionary(top, drop_level="")
    cells = sparse.term_cells(sparse.artist_term_rows(top, dictionary), ["artist_id"], dictionary, ["term"])
    return cells.select("artist_id", "term", F.col("has").cast("bigint").alias("value"))


def sparse_rows(spark, sf_dir):
    """(sparse item features, term dictionary)"""
    top = _top(spark, sf_dir, 2)
    dictionary = sparse.term_dictionary(top)
    return sparse.sparse_features(fx.songs(spark, sf_dir), top, dictionary), dictionary


@query("item_features", with_fixtures("""
    SELECT s.track_id, s.duration, s.artist_familiarity, s.artist_hotttnesss, CAST(s.year AS DOUBLE) AS year,
           CASE WHEN a.artist_id IS NOT NULL THEN COALESCE(l.terms, '') END AS terms
    FROM songs s LEFT JOIN termed a ON a.artist_id = s.artist_id
    LEFT JOIN (SELECT t.artist_id, STRING_AGG(CAST(k.idx AS VARCHAR), ',' ORDER BY k.idx) AS terms
               FROM top2 t JOIN (SELECT term, ROW_NUMBER() OVER (ORDER BY term) - 1 AS idx FROM keep_terms) k ON t.term = k.term
               GROUP BY t.artist_id) l ON l.artist_id = s.artist_id""", FEATURE_CTES))
def item_features(spark, sf_dir):
    """The item feature table as sparse rows: the numbers, and the dictionary positions of the terms."""
    rows, _ = sparse_rows(spark, sf_dir)
    numbers = [F.col("nums")[i].alias(c) for i, c in enumerate(features.NUMERIC_SONG_FEATURES)]
    return rows.select("track_id", *numbers, F.array_join("terms", ",").alias("terms"))


@query("term_dictionary", with_fixtures(
    "SELECT term, CAST(ROW_NUMBER() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM keep_terms", FEATURE_CTES))
def term_dictionary(spark, sf_dir):
    return sparse.term_dictionary(_top(spark, sf_dir, 2))


ITEM_FEATURES_LONG_SQL = with_fixtures("""
    SELECT track_id, 'duration' AS feature, duration AS value FROM songs
    UNION ALL SELECT track_id, 'artist_familiarity', artist_familiarity FROM songs
    UNION ALL SELECT track_id, 'artist_hotttnesss', artist_hotttnesss FROM songs
    UNION ALL SELECT track_id, 'year', CAST(year AS DOUBLE) FROM songs
    UNION ALL SELECT s.track_id, k.term,
        CASE WHEN a.artist_id IS NULL THEN NULL WHEN t.term IS NULL THEN 0.0 ELSE 1.0 END
    FROM songs s CROSS JOIN keep_terms k
    LEFT JOIN termed a ON a.artist_id = s.artist_id
    LEFT JOIN top2 t ON t.artist_id = s.artist_id AND t.term = k.term""", FEATURE_CTES)


@query("item_features_long", ITEM_FEATURES_LONG_SQL)
def item_features_long(spark, sf_dir):
    return sparse.long_cells(*sparse_rows(spark, sf_dir))


@query("null_term_share", with_fixtures("""
    SELECT COUNT(*) AS n_songs, COUNT(*) FILTER (WHERE a.artist_id IS NULL) AS n_null,
           ROUND(AVG(CASE WHEN a.artist_id IS NULL THEN 1 ELSE 0 END), 6) AS null_share,
           MIN(CASE WHEN a.artist_id IS NULL THEN s.track_id END) AS first_null_track
    FROM songs s LEFT JOIN termed a ON a.artist_id = s.artist_id""", FEATURE_CTES))
def null_term_share(spark, sf_dir):
    return features.null_term_share(fx.songs(spark, sf_dir), _top(spark, sf_dir, 2))


@query("rows_for_artist", with_fixtures("""
    SELECT * FROM songs WHERE artist_id = (SELECT artist_id FROM songs WHERE track_id =
        (SELECT MIN(s.track_id) FROM songs s LEFT JOIN termed a ON a.artist_id = s.artist_id WHERE a.artist_id IS NULL))""",
    FEATURE_CTES))
def rows_for_artist(spark, sf_dir):
    """Trace the first song without terms to its artist and list that artist's songs."""
    songs = fx.songs(spark, sf_dir)
    first = features.null_term_share(songs, _top(spark, sf_dir, 2)).select("first_null_track").scalar()
    artist = songs.filter(F.col("track_id") == first).select("artist_id").scalar()
    return features.rows_for_value(songs, "artist_id", artist)


@query("songs_projection", with_fixtures(
    "SELECT track_id, artist_id, duration, artist_familiarity, artist_hotttnesss, year FROM songs"))
def songs_projection(spark, sf_dir):
    return fx.songs(spark, sf_dir).select("track_id", "artist_id", "duration", "artist_familiarity",
                                          "artist_hotttnesss", "year")


TRACK_TAGS_SQL = "SELECT tid, tag, val FROM tids JOIN tid_tag USING (tid_key) JOIN tags USING (tag_key)"


@query("track_tags", with_fixtures(TRACK_TAGS_SQL))
def track_tags(spark, sf_dir):
    return features.track_tags(fx.tids(spark, sf_dir), fx.tid_tag(spark, sf_dir), fx.tags(spark, sf_dir))


@query("tag_coverage", with_fixtures(
    f"SELECT COUNT(DISTINCT tid) AS n_tid, COUNT(DISTINCT tag) AS n_tag, COUNT(DISTINCT val) AS n_val FROM ({TRACK_TAGS_SQL}) j"))
def tag_coverage(spark, sf_dir):
    return stats.column_nunique(track_tags(spark, sf_dir))


@query("lyrics_words", with_fixtures("SELECT * FROM lyrics"))
def lyrics_words(spark, sf_dir):
    return fx.lyrics(spark, sf_dir)


@query("distinct_words", with_fixtures("SELECT track_id, COUNT(DISTINCT word) AS numwords FROM lyrics GROUP BY track_id"))
def distinct_words(spark, sf_dir):
    return features.distinct_words(fx.lyrics(spark, sf_dir))


@query("artist_top_term_strict", with_fixtures("""
    SELECT artist_id, term, term_count FROM (
        SELECT a.artist_id, a.term, c.term_count,
               ROW_NUMBER() OVER (PARTITION BY a.artist_id ORDER BY c.term_count DESC, a.term) AS r
        FROM artist_term a JOIN (SELECT term, COUNT(*) AS term_count FROM artist_term GROUP BY term) c ON a.term = c.term) s
    WHERE r = 1"""))
def artist_top_term_strict(spark, sf_dir):
    return features.artist_top_term_strict(fx.artist_term(spark, sf_dir)).select("artist_id", "term", "term_count")
