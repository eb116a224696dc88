"""Property tests on random frames: exact positions and histogram running shares vs window forms."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.functions.positions import positions
from playlens.operators import stats

ROWS = st.lists(
    st.tuples(st.sampled_from([1, 1, 1, 2, 3, 4]), st.integers(0, 5)),  # user 1 dominates; small counts tie
    min_size=1, max_size=120,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 7))
def test_positions_equal_row_number(spark, rows, parts):
    data = [(u, i, c) for i, (u, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "user_id long, track_id long, count long")
    order = [F.col("count").desc(), F.col("track_id").asc()]
    got = positions(df, order, ["user_id"], num_partitions=parts)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(counts=st.lists(st.integers(1, 6), min_size=1, max_size=60))
def test_running_share_equals_range_window(spark, counts):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "track_id long, row_totals long")
    got = stats.running_share(df).select("track_id", F.round("row_running_pct", 12).alias("p"))
    w = Window.orderBy(F.col("row_totals").desc())
    want = df.select("track_id", F.round(F.sum("row_totals").over(w) / F.sum("row_totals").over(Window.partitionBy()), 12).alias("p"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
