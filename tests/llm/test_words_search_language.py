"""Spelling variants, ranked search and language ID against brute-force versions, and the defined cases:
nulls, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from playlens.llm import fingerprint, language, lexical, quality, spelling
from playlens.llm.common import WordHasher
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, word string, n int, score string, rank int, item int, terms string"


def frame(spark, rows, parts=4):
    """(doc_id, text, lang) rows with further columns whose names the operators use."""
    return spark.createDataFrame([(i, t, x, "w", 1, "s", 2, 3, "t") for i, t, x in rows], SCHEMA).repartition(parts)


# ------------------------------------------------------------------------------- spelling variants


def run_words(rows, altered):
    out = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if altered and h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return out


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_variants(n):
    near = {w: [v for v in n if distance_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def noisy_words(seed=3, size=60):
    rng = random.Random(seed)
    letters = "abcdeéß÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 14))) for _ in range(size)]
    out = list(base)
    for w in base:
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            out.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]]))
    return out + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "abababa", "abababb"]


@pytest.mark.parametrize("hot", [1, 4, 10**9])
def test_links_and_forms_match_brute_force(spark, hot):
    rng = random.Random(hot)
    n = {w: rng.choice([1, 2, 5, 25, 300, 4000]) for w in noisy_words()}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), hot=hot).collect()
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got]
    assert len(rows) == len(n) and set(rows) == brute_variants(n)


def test_spelling_over_texts(spark):
    rng = random.Random(8)
    vocab = noisy_words(5, 25)
    rows = [(i, " ".join(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", ", ", "\n", "1", "-", "漢"]) for w in rng.choices(vocab, k=80)), "x")
            for i in range(30)]
    rows += [(30, None, "x"), (31, "", None), (None, rows[0][1], "x"), rows[1], rows[1], (-7, "É" * 9 + " é", "x"), (33, "x" * 1_500_000, "y"),
             (34, ("wordwise " * 130_000), "y"), (35, "a" * 70 + " " + "a" * 70, "y")]
    for altered in (True, False):
        want = {w: c for w, c in run_words(rows, altered).items() if len(w) >= 7 and c >= 2}
        got = spelling.spelling_variants(frame(spark, rows), altered=altered).collect()
        assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(want) and len(got) == len(want)
    none = spelling.spelling_variants(frame(spark, []).limit(0))
    assert none.collect() == [] and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chain_of_forms_ends_at_its_root(spark):
    n = {"aaaaaaa" + "b" * i: 10**i for i in range(10)}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"aaaaaaa" + "b" * 9}


def test_no_join_of_words_is_a_broadcast(spark):
    words = spelling.scratch(spark.createDataFrame([(w, 9) for w in set(noisy_words())], "word string, n long"))  # a small file
    for df in (spelling.links(words, hot=3), spelling.variants(words, hot=3)):
        assert df.count() > 0
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_run_crcs_match_zlib():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    cuts = np.sort(rng.choice(5000, 300, replace=False))
    starts, ends = cuts[:-1], cuts[1:]
    starts, ends = np.append(starts, 0), np.append(ends, 400)
    before = rng.integers(0, 2**32, len(starts), dtype=np.uint64).astype(np.uint32)
    got = spelling.run_crcs(data, starts, ends, before)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


# ------------------------------------------------------------------------------- ranked search


def search_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    counts = [(i, Counter(search_terms(t))) for i, t, _ in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    big_n, big_l = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        ranked = []
        for i, c, n in counts:
            m = 100 - 75 + (75 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in search_terms(text) if t in c)
            if s > 0:
                ranked.append((-s, i is None, i or 0, i))
        ranked.sort()
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(ranked[:k])]
    return sorted(out, key=str)


def search_rows(seed=2):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcÄß漢7") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    docs = [(i, rng.choice([" ", "-", "\t"]).join(rng.choices(vocab, k=rng.randint(1, 60))), None) for i in range(120)]
    docs += [(200, None, None), (201, "", None), (202, "?! -", None), docs[4], (203, docs[4][1], None), (204, docs[4][1], None), (None, docs[4][1], None),
             (205, "Zz " * 400_000, None)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 25)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "nowhere"), (33, docs[4][1]), (33, docs[4][1]), (34, "zZ zz " * 3000), (None, docs[5][1].upper())]
    return docs, items


@pytest.mark.parametrize("group_terms", [200_000, 40])
def test_search_matches_brute_force(spark, group_terms, monkeypatch):
    monkeypatch.setattr(lexical, "DOC_TILE", 16)
    docs, items = search_rows()
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    got = lexical.search(frame(spark, docs), asked, group_terms=group_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)
    assert [r for r in lexical.search(frame(spark, docs), asked, k=1).collect() if r.rank != 1] == []


def test_search_of_empty_tables(spark):
    docs, items = search_rows()
    asked = spark.createDataFrame(items, "item_id long, text string")
    for d, i in ((frame(spark, docs), asked.limit(0)), (frame(spark, docs).limit(0), asked), (frame(spark, [(1, None, None)]), asked)):
        assert lexical.search(d, i).collect() == []


def test_tiles_keep_sums_exact(monkeypatch):
    monkeypatch.setattr(lexical, "TERM_TILE", 6)
    rng = random.Random(4)
    items = [(i, {t: rng.randint(1, 1000) for t in rng.sample(range(40), rng.randint(1, 12))}) for i in range(30)]
    exact = 1_500 * 10**6
    seen = {}
    for places, parts in lexical.tiles(items, exact):
        for terms, matrix in parts:
            assert len(terms) <= 6 and (len(terms) == 1 or (matrix.sum(axis=1) * 10**6 < exact).all())
            for i, row in zip(places.tolist(), matrix):
                for t, w in zip(terms.tolist(), row.tolist()):
                    if w:
                        seen.setdefault(i, {})[t] = int(w)
    assert seen == dict(items)


# ------------------------------------------------------------------------------- language ID


def fold(text):
    out = []
    for ch in text:
        low = ch.lower()
        keep = ch.isalpha() or unicodedata.category(ch)[0] == "M"
        out.append((low if len(low) == 1 else ch) if keep else "\0")
    return out


def brute_grams(text):
    f = ["\0", *fold(text or ""), "\0"]
    return ["".join(f[i - 1 : i + 2]) for i in range(1, len(f) - 1) if f[i] != "\0"]


def brute_language(train, texts):
    """Exact sets in place of the filter (whose false finds are corrected for): (lang, share) per text."""
    counts = defaultdict(Counter)
    for text, lang in train:
        counts[lang].update(brute_grams(text))
    totals = {x: sum(c.values()) for x, c in counts.items()}
    order = sorted((x for x in counts if totals[x]), key=lambda x: (-totals[x], x))
    rates = defaultdict(dict)
    for x in order:
        for g, c in counts[x].items():
            if c / totals[x] >= language.LEAST_RATE:
                rates[g][x] = c / totals[x]
    held = {g: {x for x, v in r.items() if v * language.RATIO >= max(r.values())} for g, r in rates.items()}
    out = []
    for text in texts:
        grams = brute_grams(text)
        if not any(ch.isalpha() for ch in text or "") or not order:
            out.append((language.UNKNOWN, 0.0))
            continue
        hits = [sum(x in held.get(g, ()) for g in grams) for x in order]
        best = max(range(len(order)), key=lambda i: (hits[i], -i))
        out.append((order[best] if hits[best] else order[0], hits[best] / len(grams)))
    return out


def language_rows():
    rng = random.Random(6)
    parts = {"aa": ["ba", "lo", "mi", "ne", "tu"], "bb": ["sch", "ung", "ei", "tz", "ba"], "cc": ["漢", "字", "の", "は"], "dd": ["क", "मा", "नि", "É"]}
    rows = []
    for i in range(160):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))).title() for _ in range(rng.randint(1, 30))) + ".", lang))
    return rows


def test_language_matches_exact_sets(spark):
    rows = language_rows()
    extra = [(500, None, "aa"), (501, "", "bb"), (502, "12 + 3 = 15 ...", "cc"), (503, "Ωμέγα", None), (504, "ba", None), rows[3], rows[3],
             (None, rows[4][1], "dd"), (505, rows[5][1] * 40_000, None), (506, "ei漢", None)]
    learned = [(t, x) for _, t, x in rows if x is not None]
    model = language.train(frame(spark, rows))
    got = {(r.doc_id, r.lang_pred, round(r.score, 4)) for r in language.predict(frame(spark, rows + extra), model).collect()}
    texts = rows + extra
    want = {(i, p, round(s, 4)) for (i, _, _), (p, s) in zip(texts, brute_language(learned, [t for _, t, _ in texts]))}
    assert got == want and all(0 <= s <= 1 for _, _, s in got)
    assert language.predict(frame(spark, rows + extra), model).count() == len(texts)


def test_language_without_rows(spark):
    rows = language_rows()[:5]
    empty = language.train(frame(spark, rows).limit(0))
    assert {(r.lang_pred, r.score) for r in language.predict(frame(spark, rows), empty).collect()} == {("und", 0.0)}
    blank = language.train(frame(spark, [(1, "123", "aa"), (2, None, "bb"), (3, "text", None)]))
    assert {r.lang_pred for r in language.predict(frame(spark, rows), blank).collect()} == {"und"}
    assert language.predict(frame(spark, rows).limit(0), language.train(frame(spark, rows))).collect() == []


def test_language_filter_is_corrected_for_false_finds(spark, monkeypatch):
    """With a small filter many absent n-grams are found, and the corrected share still names the language."""
    rows = language_rows()
    monkeypatch.setattr(language, "SLOTS", 256)
    model = language.train(frame(spark, rows))
    assert model.false_rate.max() > 0.01
    got = {r.doc_id: r.lang_pred for r in language.predict(frame(spark, rows), model).collect()}
    assert sum(got[i] == x for i, _, x in rows) >= 0.95 * len(rows)


def test_more_than_64_languages(spark):
    rows = [(i, chr(0x4E00 + 50 * i + j) * 3, f"l{i:03d}") for i in range(130) for j in range(3)]
    model = language.train(frame(spark, rows))
    got = [(r.lang_pred, r.score) for r in language.predict(frame(spark, [(i, t, None) for i, t, _ in rows]).repartition(1), model).collect()]
    assert len(model.filter) == 3 and Counter(p for p, _ in got) == Counter(x for _, _, x in rows)


def test_language_query_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", quality.held_out("doc_id", 5, 0).alias("h"))
    got = entry.queries()["op13_language"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(r.held_out == r.h for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


@pytest.mark.parametrize("key", ["op11_spelling_variants", "op12_ranked_search"])
def test_queries_match_sql(spark, key):
    res = compare(spark, duck(SF_SMALL), key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert res["status"] == "match", res


# ------------------------------------------------------------------------------- fingerprints of short texts


def test_short_text_held_whole_is_contained():
    """A text of 1 to 50 words inside a longer one has likeness 1, and a stranger of that length 0."""
    rng = random.Random(11)
    hasher = WordHasher(lower=True)
    vocab = [f"w{i}" for i in range(4000)]
    for n in [*range(1, 51), 255, 300]:
        long = rng.sample(vocab, 700)
        at = rng.randrange(700 - n)
        inside = long[at : at + n]
        texts = [" ".join(inside), " ".join(long), " ".join(f"x{i}" for i in range(n))]
        a, b, c = fingerprint.shingle_hashes(pa.array(texts), hasher)
        # Under five words the text is one shingle of its own, which no longer text has.
        assert fingerprint.likeness(a, b) == (1.0 if n >= 5 else 0.0) and fingerprint.likeness(c, b) == 0.0
        assert fingerprint.likeness(a, a) == 1.0


def test_likeness_columns_match_brute_force(spark):
    """near_edited and near_next from sets of word tuples, for texts short enough to be compared whole."""
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 120))) for _ in range(60)] + [None, "", "a b", "a b"]
    texts[10] = " ".join(texts[11].split()[:9])

    def shingles(t):
        w = (t or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    def share(a, b):
        return len(a & b) / len(a) if a and b else float(not a and not b)

    got = {r.doc_id: r for r in fingerprint.next_pairs(frame(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)] or ""
        assert got[i].near_next == pytest.approx(share(shingles(t), shingles(after)))
        assert got[i].near_edited == pytest.approx(share(shingles(t), shingles(fingerprint.edited(t or "", after))))
