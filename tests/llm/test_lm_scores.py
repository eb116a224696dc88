"""Language-model scores from dictionaries of counts: histogram, learned weights and every text's score."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import lm

LOWER = {c: c + 32 for c in range(65, 91)}
BEGIN, END = "<begin>", "<end>"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def bucket(c):
    return 0 if c <= 0 else 1 + int(math.floor(math.log2(c)))


def brute_scores(rows):
    """(known, base, score) per row of (id, text, train)."""
    one, two, begins = Counter(), Counter(), 0
    for _, text, train in rows:
        if train:
            t = tokens(text)
            one.update(t)
            two.update(zip([BEGIN, *t], t))
            begins += 1
    n, v = sum(one.values()), len(one)

    def context(word):
        return begins if word == BEGIN else one[word]

    held = Counter()
    for _, text, train in rows:
        if train:
            t = tokens(text)
            for before, word in zip([BEGIN, *t], t):
                c2, ch, c1 = two[before, word] - 1, context(before) - 1, one[word] - 1
                q2 = round(math.log(c2 / ch * (v + 1)) / lm.GRID) if c2 > 0 else -10_000
                q1 = round(math.log(c1 / max(n - 1, 1) * (v + 1)) / lm.GRID) if c1 > 0 else -10_000
                held[bucket(ch), q2, q1] += 1
    weights = lm.mixture([{"context": c, "q2": a, "q1": b, "n": k} for (c, a, b), k in sorted(held.items())])
    top, filled, last = max(weights, default=0), {}, (0.0, 0.5, 0.5) if weights else (0.0, 0.0, 1.0)
    for k in range(top + 1):
        last = filled[k] = weights.get(k, last)
    out = []
    for _, text, _ in rows:
        t = tokens(text)
        score = 0.0
        for before, word in zip([BEGIN, *t], t):
            ch = context(before)
            w2, w1, w0 = filled[min(bucket(ch), top)]
            score += math.log10(w2 * (two[before, word] / ch if ch else 0) + w1 * one[word] / max(n, 1) + w0 / (v + 1))
        out.append((len(t), sum(one[w] > 0 for w in t), n, sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), score))
    return out


@pytest.mark.parametrize("batch_bytes", [lm.BATCH_BYTES, 2000])
def test_scores_match_dictionaries(spark, monkeypatch, batch_bytes):
    """Whole results, also where the texts are many batches and buckets, with words of more than 255 occurrences."""
    monkeypatch.setattr(lm, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 2 * batch_bytes)
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(rng.choice(vocab[: rng.choice([3, 20, 150])]).title() for _ in range(rng.randint(0, 60))), i % 7 != 2) for i in range(120)]
    rows += [(200, None, True), (201, "", False), (202, "unseen words only", False), (203, "the the " * 400, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fit boolean").repartition(3)
    got = {r.doc_id: r for r in lm.scores(df, F.col("fit")).collect()}
    assert len(got) == len(rows)
    for (i, _, fit), (n, known, train_tokens, base, score) in zip(rows, brute_scores(rows)):
        r = got[i]
        assert (r.train, r.n_tokens, r.n_known, r.train_tokens) == (fit, n, known, train_tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-6)


def test_packed_counts_round_trip():
    rng = np.random.default_rng(3)
    for x in (np.zeros(0, np.int64), np.array([0, 254, 255, 256]), rng.integers(0, 400, 1000), np.array([2**40, 1, 255]), np.array([2**32 - 1, 7])):
        assert lm._unpack(lm._pack(x), len(x)).tolist() == x.tolist()
