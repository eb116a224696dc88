"""Every sub-command of jobs/cli.py on files, against what the operators give on the same rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from jobs import cli
from playlens.operators import downsample, features, recommend, sparse, stats
from playlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    out = {"root": folder}
    for name in ("train", "val", "songs", "artist_term", "item_factors", "user_factors"):
        out[name] = str(folder / name)
        fx.load(spark, SF_SMALL, name).write.parquet(out[name])
    out["val_users"] = str(folder / "val_users")
    fx.val_users(spark, SF_SMALL).select(F.col("id").alias("user_hashId")).write.parquet(out["val_users"])
    out["dictionary"] = str(folder / "dictionary")
    fx.songs(spark, SF_SMALL).select("track_id", F.col("track_id").cast("int").alias("item_hashId")).write.parquet(out["dictionary"])
    return out


def rows(df):
    return sorted(map(str, df.collect()))


def test_stats(files, capsys):
    cli.main(["stats", "--input", files["train"]])
    assert '"n_rows"' in capsys.readouterr().out


def test_downsampling_commands(spark, files):
    train = spark.read.parquet(files["train"])
    for command, want in ((["top-n", "--n", "20"], downsample.downsample_top_n(train, 20)),
                          (["sample", "--fraction", "0.5", "--seed", "3"], downsample.downsample_random_items(train, 0.5, 3))):
        out = str(files["root"] / command[0])
        cli.main([command[0], "--input", files["train"], "--output", out, *command[1:]])
        assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want)


def test_usage_csv_feeds_long_tail(spark, files, capsys):
    usage, curve = str(files["root"] / "usage"), str(files["root"] / "curve")
    cli.main(["usage-csv", "--input", files["train"], "--output", usage])
    cli.main(["long-tail", "--usage", usage, "--output", curve])
    items = spark.read.parquet(files["train"]).select("track_id").distinct().count()
    assert spark.read.parquet(curve).count() == items and '"unique_plays"' in capsys.readouterr().out


def test_popular_and_baseline(spark, files, capsys):
    popular = str(files["root"] / "popular")
    cli.main(["popular", "--input", files["train"], "--output", popular, "--n", "30"])
    assert rows(spark.read.parquet(popular)) == rows(recommend.popular_items(spark.read.parquet(files["train"]), 30))
    cli.main(["baseline", "--popular", popular, "--val", files["val"]])
    assert '"map"' in capsys.readouterr().out


def test_item_hash(spark, files, capsys):
    out = str(files["root"] / "hashes")
    cli.main(["item-hash", "--input", files["train"], "--output", out])
    assert spark.read.parquet(out).columns == ["track_id", "item_hashId"] and '"n_colliding_ids"' in capsys.readouterr().out


@pytest.mark.parametrize("repeat", [False, True])
def test_restrict(spark, files, repeat):
    out = str(files["root"] / f"restricted-{repeat}")
    cli.main(["restrict", "--train", files["train"], "--val", files["val"], "--output", out, *(["--repeat"] if repeat else [])])
    train, val = spark.read.parquet(files["train"]), spark.read.parquet(files["val"])
    users = val.select("user_id") if repeat else val.select("user_id").distinct()
    assert spark.read.parquet(out).count() == train.join(users, "user_id").count()


def test_als_commands(spark, files, capsys):
    cli.main(["als-grid", "--train", files["train"], "--val", files["val"], "--max-iter", "1", "--ranks", "2,3", "--regs", "0.1", "--k", "20"])
    assert capsys.readouterr().out.count('"map"') == 2
    model = str(files["root"] / "als")
    cli.main(["als-fit", "--train", files["train"], "--model", model, "--rank", "2", "--reg", "0.1", "--max-iter", "1"])
    assert spark.read.parquet(f"{model}/itemFactors").count() == spark.read.parquet(files["train"]).select("track_id").distinct().count()


def test_features(spark, files):
    out = str(files["root"] / "features")
    cli.main(["features", "--songs", files["songs"], "--terms", files["artist_term"], "--output", out])
    top = features.artist_top_terms(spark.read.parquet(files["artist_term"]), 2)
    terms = sparse.term_dictionary(top)
    assert rows(spark.read.parquet(f"{out}/terms").select("term", "idx")) == rows(terms)
    want = sparse.sparse_features(spark.read.parquet(files["songs"]), top, terms)
    assert rows(spark.read.parquet(f"{out}/rows").select(*want.columns)) == rows(want)


def test_linear_grid(files, capsys):
    cli.main(["linear-grid", "--factors", files["item_factors"], "--dictionary", files["dictionary"], "--songs", files["songs"],
              "--terms", files["artist_term"]])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert len(lines) == 12 and {x["model"] for x in lines} == {"ridge", "lasso"}


def test_topk(spark, files):
    out = str(files["root"] / "topk")
    cli.main(["topk", "--users", files["user_factors"], "--items", files["item_factors"], "--val-users", files["val_users"], "--output", out, "--k", "7"])
    got = spark.read.parquet(out)
    assert got.groupBy("user_id").count().where("count <> 7").count() == 0
    assert got.select("user_id").distinct().count() == fx.val_users(spark, SF_SMALL).count()


def test_stats_module_is_the_same(spark, files):
    assert stats.basic_stats(spark.read.parquet(files["train"])).first()["n_rows"] == spark.read.parquet(files["train"]).count()
