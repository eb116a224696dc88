"""spark-submit entry point: one sub-command per composed job, arguments named.

    spark-submit jobs/cli.py stats        --input train.parquet
    spark-submit jobs/cli.py downsample   --input train.parquet --output out --cutoff 0.5
    spark-submit jobs/cli.py top-n        --input train.parquet --output out --n 100000
    spark-submit jobs/cli.py sample       --input train.parquet --output out --fraction 0.5 --seed 0
    spark-submit jobs/cli.py usage-csv    --input train.parquet --output usage_csv
    spark-submit jobs/cli.py long-tail    --usage usage_csv --output long_tail
    spark-submit jobs/cli.py popular      --input train.parquet --output popular --n 500
    spark-submit jobs/cli.py item-hash    --input train.parquet --output items_hash
    spark-submit jobs/cli.py restrict     --train train.parquet --val val.parquet --output out [--repeat]
    spark-submit jobs/cli.py baseline     --popular popular --val val.parquet
    spark-submit jobs/cli.py als-grid     --train t.parquet --val v.parquet --max-iter 10 [--ranks 10,20] [--regs 0.01]
    spark-submit jobs/cli.py als-fit      --train t.parquet --model model_dir --rank 200 --reg 0.1 --max-iter 10
    spark-submit jobs/cli.py features     --songs songs.parquet --terms artist_term.parquet --output items_meta [--top 2]
    spark-submit jobs/cli.py coldstart    --factors itemFactors --dictionary items_hash --songs songs --terms artist_term
                                          --output itemFactors_patched [--slices 10] [--top 2] (else files of 256 MiB)
    spark-submit jobs/cli.py linear-grid  --factors itemFactors --dictionary items_hash --songs songs --terms artist_term
    spark-submit jobs/cli.py topk         --users userFactors --items itemFactors --val-users valUsers --output recs --k 500

Interaction inputs have (user_id, track_id, count); factor inputs (id, features). The checkpoint folder
comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from playlens.functions import keys  # noqa: E402
from playlens.operators import coldstart, downsample, features, metrics, recommend, sparse, stats  # noqa: E402
from playlens.session import build_session  # noqa: E402
from playlens.sources import sinks  # noqa: E402
from playlens.sources.tables import read_parquet_dir, read_usage_csv  # noqa: E402


def _print(df) -> None:
    for row in df.collect():  # one-row summaries only
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="playlens")
    sub = p.add_subparsers(dest="cmd", required=True)

    def cmd(name, *args):
        sp = sub.add_parser(name)
        for a in args:
            sp.add_argument(f"--{a}", required=a not in ("n", "k", "seed", "top", "ranks", "regs", "slices", "drop-level"))
        return sp

    cmd("stats", "input")
    cmd("downsample", "input", "output", "cutoff")
    cmd("top-n", "input", "output", "n")
    cmd("sample", "input", "output", "fraction", "seed")
    cmd("usage-csv", "input", "output")
    cmd("long-tail", "usage", "output")
    cmd("popular", "input", "output", "n")
    cmd("item-hash", "input", "output")
    cmd("restrict", "train", "val", "output").add_argument("--repeat", action="store_true")
    cmd("baseline", "popular", "val")
    cmd("als-grid", "train", "val", "max-iter", "ranks", "regs", "k")
    cmd("als-fit", "train", "model", "rank", "reg", "max-iter")
    cmd("features", "songs", "terms", "output", "top", "drop-level")
    cmd("coldstart", "factors", "dictionary", "songs", "terms", "output", "slices", "top")
    cmd("linear-grid", "factors", "dictionary", "songs", "terms", "top")
    cmd("topk", "users", "items", "val-users", "output", "k")
    a = p.parse_args(argv)

    spark = build_session(app=f"playlens-{a.cmd}")
    start = time.time()
    read = lambda path: read_parquet_dir(spark, path)

    if a.cmd == "stats":
        _print(stats.basic_stats(read(a.input)))
    elif a.cmd == "downsample":
        sinks.write_parquet(downsample.downsample_by_share(read(a.input), float(a.cutoff)), a.output)
    elif a.cmd == "top-n":
        sinks.write_parquet(downsample.downsample_top_n(read(a.input), int(a.n)), a.output)
    elif a.cmd == "sample":
        sinks.write_parquet(downsample.downsample_random_items(read(a.input), float(a.fraction), int(a.seed or 0)), a.output)
    elif a.cmd == "usage-csv":
        sinks.write_csv(stats.item_usage(read(a.input)), a.output)
    elif a.cmd == "long-tail":
        usage = read_usage_csv(spark, a.usage)
        curve = stats.cumulative_share_rows(usage, rank_col="rank")
        sinks.write_parquet(curve, a.output)
        _print(stats.share_thresholds(curve, "pct_plays"))
        _print(stats.share_at_most(usage))
        _print(stats.quantiles(usage, "unique_plays", [i / 10 for i in range(1, 11)], "unique_plays"))
    elif a.cmd == "popular":
        sinks.write_parquet(recommend.popular_items(read(a.input), int(a.n or 500)), a.output)
    elif a.cmd == "item-hash":
        items = keys.item_dictionary(read(a.input))
        sinks.write_parquet(items, a.output)
        _print(keys.hash_audit(read(a.output), "track_id", "item_hashId"))
    elif a.cmd == "restrict":
        fn = downsample.restrict_to_users_repeated if a.repeat else downsample.restrict_to_users
        sinks.write_parquet(fn(read(a.train), read(a.val)), a.output)
    elif a.cmd == "baseline":
        popular = read(a.popular)
        _print(metrics.shared_list_metrics(popular, read(a.val), max_list=popular.count()))
    elif a.cmd == "als-grid":
        ranks = [int(x) for x in (a.ranks or "10,20,50,100,200").split(",")]
        regs = [float(x) for x in (a.regs or "0.001,0.01,0.1,1").split(",")]
        train, val = keys.with_hash_ids(read(a.train)), keys.with_hash_ids(read(a.val))
        _print(recommend.als_grid(train, val, ranks, regs, int(a.max_iter), int(a.k or 500)))
    elif a.cmd == "als-fit":
        model = recommend.fit_als(keys.with_hash_ids(read(a.train)), int(a.rank), float(a.reg), int(a.max_iter))
        sinks.save_model(model, a.model)
    elif a.cmd == "features":
        top = features.artist_top_terms(read(a.terms), int(a.top or 2))
        terms = sparse.term_dictionary(top, a.drop_level)
        sinks.write_parquet(terms, f"{a.output}/terms")
        sinks.write_parquet(sparse.sparse_features(read(a.songs), top, terms), f"{a.output}/rows")
    elif a.cmd in ("coldstart", "linear-grid"):
        top = features.artist_top_terms(read(a.terms), int(a.top or 2))
        terms = sparse.term_dictionary(top)
        dictionary = read(a.dictionary).select("track_id", F.col("item_hashId").alias("item_id"))
        scaled = coldstart.prepare(read(a.factors), dictionary, sparse.sparse_features(read(a.songs), top, terms), terms)
        if a.cmd == "coldstart":
            pred = coldstart.knn_predict(scaled)
            _print(coldstart.knn_errors(pred))
            patched = coldstart.patched_factors(scaled.train, pred)
            if a.slices:
                sinks.write_slices(patched, a.output, int(a.slices))
            else:
                sinks.write_sized(patched, a.output)
        else:
            _print(coldstart.linear_grid(scaled, [10.0 ** e for e in range(-3, 3)]))
    elif a.cmd == "topk":
        users = read(a.users).join(read(a.val_users).select(F.col("user_hashId").alias("id")), "id", "left_semi")
        recs = recommend.top_k_scores(users, read(a.items), int(a.k or 500))
        sinks.write_parquet(recs, a.output)
    print(f"{a.cmd}: {time.time() - start:.1f}s", file=sys.stderr)


if __name__ == "__main__":
    main()
