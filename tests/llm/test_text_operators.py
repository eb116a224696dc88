"""Text operators against brute-force versions, and the defined cases: nulls, empty and long texts, ties,
repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from playlens.llm import fingerprint, lm, minhash, packing, pii, quality, segmentation, substring
from playlens.llm.common import string_buffer
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, score string, n int, key string, row string, sig int, n_chars long"


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def made(seed=5):
    """Texts with copies, near copies, shared passages, and the odd cases."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdéß漢") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    def text(n):
        return " ".join(rng.choice(vocab) for _ in range(n))
    passage, base = text(70), text(120).split()
    out = [text(rng.randint(1, 160)) for _ in range(30)]
    out += [out[3], out[3], text(20) + "\n" + passage + "\t" + text(30), passage, text(5) + " " + passage]
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(len(near))] = "x%d" % rng.randrange(50)
        out.append(" ".join(near))
    out += [None, "", "  \n ", "A", "a b c d", "A b C d", text(9000), "x" * 3000, "﻿ a\x1cb a"]
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", 1, "k", "r", 2, len(t or "")) for i, t in made()]
    rows += [rows[0], rows[0], (None, rows[1][1], None, None, None, None, None, None), (None, None, *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(rows):
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}
    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in sets:
        for b in sets:
            inter = len(sets[a] & sets[b])
            if a < b and inter and 100 * inter >= 75 * (len(sets[a]) + len(sets[b]) - inter):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def test_minhash_groups(docs, none):
    want = groups(made())
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert set(ids) == {i for i, w in want.items() if w[2]} | {None} and ids[1] == 3 and ids[None] == 2


def test_buckets_without_links_are_compared_across_components(spark, monkeypatch):
    # 30 texts share 60 % of their words: they meet in buckets, but only some pairs reach 75 %.
    rng = random.Random(2)
    common = [f"w{k}" for k in range(150)]
    rows = [(i, " ".join(common + [f"t{i // 3}x{k}" for k in range(60)] + [f"u{i}y{k}" for k in range(10 * (i % 3))])) for i in range(30)]
    monkeypatch.setattr(minhash, "BLOCK", 7)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: w[1] for i, w in groups(rows).items()} and rng


def cut(rows):
    first, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                gone[k : k + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def test_signature_test_misses_far_less_than_banding():
    n, least = minhash.HASHES, math.ceil(minhash.MIN_ESTIMATE * minhash.HASHES)
    signature = sum(math.comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(least))
    banding = (1 - 0.75 ** (n // minhash.BANDS)) ** minhash.BANDS
    assert signature < 1e-3 * banding


def test_repeated_passages(docs, none):
    want = cut(made())
    got = substring.repeated_passages(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert tuple(r)[1:] == want[r.doc_id][:3]
        else:
            assert r.n_removed == 0
    carried = substring.repeated_passages(docs, carry=["doc_id", "score", "row"]).collect()
    for r in carried:
        if r.doc_id is not None and r.kept_text is not None:
            assert words(r.kept_text) == want[r.doc_id][3] and r.row.row == "r"
    assert substring.repeated_passages(none).count() == 0


def test_difference_cover_meets_every_shift():
    p, cover = substring.PERIOD, set(substring.COVER)
    assert {(a - b) % p for a in cover for b in cover} == set(range(p)) and p <= substring.WINDOW


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_on_random_texts(spark):
    rng = random.Random(1)
    parts = ["a", "1", ".", "@", "-", " ", "+", "(", ")", "25", "é", "𝄞", "a@b.c", "4111 1111 1111 1111", "1.2.3.4", "+1 (234) 567-8901", "_", "\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(800)]
    rows += [(900, None), (901, ""), (902, "1" * 3000), (903, "a" * 5000 + "@b.c"), (904, "1 " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = df.select("text", pii.spans(F.col("text"), pii.Model()).alias("s")).select("text", pii.joined(F.col("s.base")).alias("b"))
    for r in found.collect():
        assert r.b == base_spans(r.text)


def test_pii_training_adds_and_redacts(spark):
    rows = [(i, f"word {i} call +1 (234) 555-{1000 + i} or u{i}@host.org then 10.0.{i}.7 end") for i in range(120)]
    rows += [(200 + i, f"word {i} paid 4111111111111111 then ordered {1234567890123450 + i} more") for i in range(120)]
    # The base pattern runs over both numbers and fails on 32 digits; the method finds each.
    rows += [(500, "paid 4111111111111111 4111111111111111 then left"), (501, None), (502, "clean text at noon. Nothing")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, found string")
    model = pii.train(df)
    clean = {r.doc_id: r.t for r in df.select("doc_id", pii.redacted(df["text"], model).alias("t")).collect()}
    assert clean[3] == "word 3 call [PHONE] or [EMAIL] then [IP] end"
    assert clean[500] == "paid [CARD] [CARD] then left"
    assert clean[200] == "word 0 paid [CARD] then ordered 1234567890123450 more"
    assert clean[501] is None and clean[502] == rows[-1][1]
    again = pii.train(df.limit(0))
    assert not again.trees and not again.threshold


def test_pii_finds_planted_cases_of_every_generator(spark):
    cases = [
        ("email", True, "reach bob{i}(at)host{i}.org today"), ("email", True, "reach bob{i} [at] host [dot] org today"),
        ("email", True, "mail bob{i} at host dot org today"), ("email", False, "we met{i} at noon dot matrix printers hum"),
        ("ip", True, "node 10[.]0[.]{i}[.]7 is down"), ("ip", False, "see 3. 1. {i}. 7 in the list"),
        ("phone", True, "phone 0170 555 {n} now"), ("phone", True, "dial 0044 170 555 {i:02d} now"), ("phone", False, "sold 2019 555 {n} units"),
        ("card", True, "card 4111/1111/1111/1111 used{i}"), ("card", False, "order 4111/1111/1111/1112 was{i}")]
    rows = [(i, f"word {i} call +1 (234) 555-{1000 + i} or u{i}@host.org then 10.0.{i}.7 paid 4111111111111111 end") for i in range(120)]
    rows += [(1000 * (k + 1) + i, text.format(i=i, n=1000 + i)) for k, (_, _, text) in enumerate(cases) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(df)
    found = df.select("doc_id", pii.joined(pii.spans(F.col("text"), model)["spans"]).alias("s")).where("doc_id >= 1000").collect()
    hits = {}
    for r in found:
        kind, real, _ = cases[r.doc_id // 1000 - 1]
        hits[r.doc_id // 1000 - 1] = hits.get(r.doc_id // 1000 - 1, 0) + (kind in r.s)
    assert [hits[k] for k in range(len(cases))] == [30 * real for _, real, _ in cases]


def test_quality_is_learned_from_rows_not_held_out(spark):
    q = entry.queries()["op1_quality"](spark, SF_SMALL).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas()
    assert all(q.held_out[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in q.index)
    held = labels[labels.doc_id.map(q.held_out)]
    assert (q.predicted[held.doc_id].to_numpy() == held.quality.to_numpy()).mean() >= 0.95
    assert q.score.between(0, 1).all()


def test_quality_cases(spark, docs, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, empty)
    assert {r.score for r in quality.scores(docs, model).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i, _ in made()] + [(None, 1), (10**9, 0), (4, None), (7, 5)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scored = quality.scores(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.score >= 0.5 for r in scored)
    assert quality.keep_good(none, model).count() == 0


def test_lm_scores(docs, none):
    held = quality.held_out("doc_id", 7, 2)
    got = lm.scores(docs, ~held).collect()
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    count = Counter()
    for r in rows:
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            count.update([*words(r.text, True), None])
    n, v = sum(count.values()), len(count)
    text = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            w = [*words(text[r.doc_id], True), None]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
            assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
            assert r.score < 0
    assert lm.scores(none, F.lit(True)).count() == 0


def test_lm_mixture_beats_the_base_on_held_out_text(spark):
    q = entry.queries()["op5_lm_scores"](spark, SF_SMALL).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert q[0] > q[1]


def test_mixture_weights_are_the_likelihood_maximum():
    rows = [{"context": 1, "q2": 8, "q1": 2, "n": 70}, {"context": 1, "q2": -10_000, "q1": 3, "n": 30}]
    w = np.array(lm.mixture(rows)[1])
    def value(w):
        p = [w @ [math.exp(2), math.exp(0.5), 1], w @ [0, math.exp(0.75), 1]]
        return 70 * math.log(p[0]) + 30 * math.log(p[1])
    grid = [np.array([a, b, 100 - a - b]) / 100 for a in range(101) for b in range(101 - a)]
    assert value(w) >= max(value(g) for g in grid if g[1] + g[2] > 0) - 0.05


def test_fingerprints(docs, none):
    got = fingerprint.next_pairs(docs).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by_text = defaultdict(set)
    text = {i: t for i, t in rows if i is not None}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            by_text[text[r.doc_id]].add(r.fingerprint)
            assert (r.fingerprint == "") == (not words(text[r.doc_id]))
    assert all(len(f) == 1 for f in by_text.values())
    assert fingerprint.next_pairs(none).count() == 0


def test_sketches_merge_and_estimate_containment():
    from playlens.llm.common import WordHasher
    import pyarrow as pa

    rng = random.Random(4)
    w = [f"v{rng.randrange(10**6)}" for _ in range(8000)]
    small, large = " ".join(w[:2000]), " ".join(w)
    a, b, rest = fingerprint.sketches(pa.array([small, large, " ".join(w[1996:])]), WordHasher(lower=True))
    assert fingerprint.containment(a, b) == 1 and abs(fingerprint.containment(b, a) - 0.25) < 0.05
    assert set(b) == set(a) | set(rest)


def test_packing(docs, none, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(packing.pieces(docs, path), shard=16).toPandas()
    tok = Tokenizer.from_file(path)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids, start, k = [*tok.encode(r.text or "", add_special_tokens=False).ids, 2], 0, 0
        while start < len(ids):
            size = (len(ids) % 1024 or 1024) if start == 0 else 1024
            want[r.doc_id or -1, k, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())] += 1
            start, k = start + size, k + 1
    assert Counter(zip(got.doc_id.fillna(-1).astype(int), got.piece, got.start, got.length, got.ids_crc32)) == want
    seqs = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (seqs.length.sum() <= 1024).all()
    assert all((g.offset == g.length.cumsum() - g.length).all() for _, g in seqs)
    assert len(seqs) <= -(-got.length.sum() // 1024) + 2
    assert packing.pack(packing.pieces(none, path)).count() == 0


def test_chunk_ids_are_those_of_whole_texts(monkeypatch):
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(5)
    parts = [" ", "\n", "  ", ".", ",", "!", "&&", ")", "a", "Bc", "the", "'s", "'", "1", "é", "日", "\t", "\u3000", "<|endoftext|>"]
    texts = ["", None, " ", "it's.", "x\t y.", *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(500))]
    column = pa.array(texts, pa.string())
    data, offsets = string_buffer(column)
    chunks = packing._Chunks(packing._chunk_ids(path).tokenizer)
    monkeypatch.setattr(packing, "_JOINED", 7)
    for limit in (0, packing._CACHE_ENTRIES):  # chunks forgotten, chunks known
        monkeypatch.setattr(packing, "_CACHE_ENTRIES", limit)
        ids, first = chunks.encoded(column, data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [
            chunks.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_worker_process_reads_the_tokenizer_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing._chunk_ids(path) is packing._chunk_ids(path)


def test_crossover_keeps_every_piece_once():
    rng = random.Random(3)
    sizes = [rng.randint(1, 1023) for _ in range(300)]
    a, b = (packing._fresh(sizes, 1024, rng, x) for x in (0.0, 0.2))
    child = packing._cross(a, b, sizes, 1024, rng)
    assert sorted(i for g in child for i in g) == list(range(300)) and all(sum(sizes[i] for i in g) <= 1024 for g in child)
    assert packing._fitness(packing.evolve(sizes, 1024, 1, [a]), sizes) <= packing._fitness(a, sizes)


def test_segmentation_round_trip_and_cases(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = segmentation.encode(docs, path, check=True)
    rows = got.collect()
    assert all(r.round_trip for r in rows) and {r["sample"] for r in rows} == {0, 1}
    distinct = {(r.doc_id, r["sample"], tuple(r.pieces)) for r in rows if r.doc_id is not None}
    assert len(distinct) == len({(r.doc_id, r["sample"]) for r in rows if r.doc_id is not None})
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}
    for r in segmentation.decode(got.where("doc_id is not null"), path).collect():
        assert r.text == text[r.doc_id]
    again = {(r.doc_id, r["sample"]): r.pieces for r in segmentation.encode(docs.repartition(2), path).where("doc_id is not null").collect()}
    assert all(again[r.doc_id, r["sample"]] == r.pieces for r in rows if r.doc_id is not None)
    assert segmentation.encode(none, path).count() == 0


def test_words_are_those_of_the_pattern():
    rng, start = random.Random(4), "▁"
    texts = ["", " ", "\n", *("".join(rng.choices([" ", "\n", "a", "é", "日", start], k=rng.randint(1, 12))) for _ in range(400))]
    own, which, first = segmentation._words(texts)
    for text, a, b in zip(texts, first[:-1], first[1:]):
        marked = start + text.replace(start, "\udc81").replace(" ", start)
        assert [own[k] for k in which[a:b]] == (re.findall(f"\n|{start}+[^{start}\n]*|[^{start}\n]+", marked) if text else [])


def test_forgotten_lattices_do_not_change_samples_and_places_without_a_match_are_left_early():
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocab = segmentation._vocabulary(path)
    assert vocab is segmentation._vocabulary(path)
    rows = [(k * 31, f"some words of text {k} with 日本 and xqzj{k}\n  twice") for k in range(20)]
    want = [(r, n, list(ids), *rest) for r, n, ids, *rest in segmentation._encode_rows(vocab, segmentation.Lattices(vocab), rows, 2)]
    lat, got = segmentation.Lattices(vocab), []
    for at in range(0, 20, 5):
        lat.clear()
        got += [(at + r, n, list(ids), *rest) for r, n, ids, *rest in segmentation._encode_rows(vocab, lat, rows[at : at + 5], 2)]
    assert got == want and all(vocab.decode(x[2]) == rows[x[0]][1] for x in got)
    for piece in vocab.edge:  # all beginnings of a piece are known, so no match is lost
        run = np.zeros(1, np.uint64)
        for k, point in enumerate(segmentation._points(piece)[:-1], 1):
            run = run * np.uint64(segmentation._MULT) + point + np.uint64(1)
            assert vocab.begins[k][segmentation.mix(run) >> np.uint64(46)].all()


def test_building_lattices_holds_little_more_than_the_lattices():
    vocab = segmentation._vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    words = list({"▁" + "".join(rng.choices("abdehinorstz", k=rng.randint(2, 14))) for _ in range(30_000)})
    lat, alone = segmentation.Lattices(vocab), segmentation.Lattices(vocab)
    tracemalloc.start()
    lat.add(words)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - now < 25e6  # 99 MB when all words were worked on, and all arrays doubled, at once
    for word in words[:300]:
        alone.add([word])
    names = ("code", "next", "of", "cdf", "logp")
    assert all((getattr(lat, x)[: alone.size] == getattr(alone, x)[: alone.size]).all() for x in names)
    assert (lat.first[: alone.nodes + 1] == alone.first[: alone.nodes + 1]).all()


def test_every_piece_is_found_also_where_pieces_share_the_top_bits_of_their_hash():
    vocab = segmentation._vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert any(np.diff(begin).max() > 1 for *_, begin in vocab.by_length.values())
    lat = segmentation.Lattices(vocab)
    lat.add(list(vocab.edge))
    for piece, (i, _) in vocab.edge.items():
        e = lat.first[lat.root[piece]]
        assert lat.code[e] == i and lat.next[e] == -1


def test_segmentation_of_batches_worked_on_in_parts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    long = "some long words and 日本 again " * 40_000
    assert len(long) > segmentation._BATCH_BYTES
    texts = ["before", None, long, "", "right after", "last\n one"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = segmentation.encode(df, path, check=True).collect()
    assert Counter(r.doc_id for r in got) == {0: 2, 1: 1, 2: 2, 3: 1, 4: 2, 5: 2} and all(r.round_trip for r in got)
    single = {(r.doc_id, r["sample"]): r.pieces for k in (0, 4, 5) for r in segmentation.encode(df.where(f"doc_id = {k}"), path).collect()}
    assert all(r.pieces == single[r.doc_id, r["sample"]] for r in got if r.doc_id in (0, 4, 5))


def test_segmentation_samples_without_replacement():
    vocab = segmentation.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    lat = segmentation.Lattices(vocab)
    lat.add(["▁abc"])

    def paths(node):
        if node < 0:
            yield (), 0.0
            return
        for e in lat.edges(node):
            for tail, lp in paths(int(lat.next[e])):
                yield (int(lat.code[e]), *tail), lp + float(lat.logp[e])

    prob = {p: math.exp(lp) for p, lp in paths(lat.root["▁abc"])}
    assert math.isclose(sum(prob.values()), 1)
    n, first, second, total = 6000, Counter(), Counter(), 0.0
    for r, rank, ids, lp, _, inc in segmentation._encode_rows(vocab, lat, [(k * 7919, "abc") for k in range(n)], 2):
        (first if rank == 0 else second)[tuple(ids)] += 1
        total += math.exp(lp - inc)
    assert max(abs(first[p] / n - q) for p, q in prob.items()) < 0.02
    after = {p: sum(q * prob[p] / (1 - q) for o, q in prob.items() if o != p) for p in prob}
    assert max(abs(second[p] / n - q) for p, q in after.items()) < 0.02
    assert abs(total / n - 1) < 0.05  # inclusion scores make the sample unbiased
