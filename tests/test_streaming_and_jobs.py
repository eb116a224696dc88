"""Streamed item usage equals the batch result; job CLI round trips on the test tables."""

from __future__ import annotations

from playlens.operators import stats
from playlens.sources import fixtures as fx
from playlens.streaming.item_usage import start_usage_stream
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark, tmp_path):
    train = fx.train(spark, SF_SMALL)
    folder = str(tmp_path / "in")
    train.repartition(4).write.parquet(folder)  # four files arriving
    q = start_usage_stream(spark, folder, str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = stats.item_usage(train)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_cli_downsample_and_stats(spark, tmp_path, capsys):
    from jobs import cli

    src = str(tmp_path / "train")
    fx.train(spark, SF_SMALL).write.parquet(src)
    cli.main(["downsample", "--input", src, "--output", str(tmp_path / "ds"), "--cutoff", "0.5"])
    cli.main(["stats", "--input", str(tmp_path / "ds")])
    out = capsys.readouterr().out
    assert '"n_rows"' in out


def test_cli_coldstart_end_to_end(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from jobs import cli

    paths = {}
    for name in ("songs", "artist_term", "item_factors"):
        paths[name] = str(tmp_path / name)
        fx.load(spark, SF_SMALL, name).write.parquet(paths[name])
    paths["dict"] = str(tmp_path / "dict")
    fx.songs(spark, SF_SMALL).select("track_id", F.col("track_id").cast("int").alias("item_hashId")).write.parquet(paths["dict"])
    out = str(tmp_path / "patched")
    cli.main(["coldstart", "--factors", paths["item_factors"], "--dictionary", paths["dict"], "--songs", paths["songs"],
              "--terms", paths["artist_term"], "--output", out, "--slices", "3"])
    assert '"mse"' in capsys.readouterr().out
    patched = spark.read.parquet(out)
    assert patched.count() == fx.item_factors(spark, SF_SMALL).join(fx.songs(spark, SF_SMALL),
                                                                    F.col("id") == F.col("track_id")).count()


def test_entry_runs_from_another_directory(tmp_path):
    """Workers need not import the package: task functions ship by value (cloudpickle)."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import importlib.util\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"spec = importlib.util.spec_from_file_location('entry', {os.path.join(repo, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        f"print('ROWS', m.queries()['topk_scores'](spark, {SF_SMALL!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS " in out.stdout, out.stderr[-2000:]
