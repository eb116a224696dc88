"""Page text, embedding groups and the pipeline against brute-force versions, with the defined cases."""

from __future__ import annotations

import html
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from playlens.llm import embedding, html_text
from playlens.llm.common import scratch
from playlens.llm.components import components
from tests.conftest import SF_SMALL


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("cells", [1 << 26, 4])
def test_alignment_is_a_longest_common_subsequence(cells):
    rng = random.Random(2)
    for _ in range(600):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = html_text.common_lines(a, b, cells)
        assert len(pairs) == lcs(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_article_pages(spark):
    got = {r.page_id: r for r in entry.queries()["op2_html_text"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*)</article>", p.html, re.S).group(1).replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        lines = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(x for x in lines if x)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def test_differencing_removes_template_lines_without_markup_help(spark):
    def page(k):
        return f"<html><body><div>Our site</div><p>All about us</p><div>story {k} begins</div><p>it ends {k}</p><span>call now</span></body></html>"
    rows = [(k, f"https://h.example/a/{k:03d}", page(k), "x") for k in range(40)]
    rows += [(100, None, None, "x"), (101, "odd", "", "x"), (102, "https://z.example/", "<p>alone</p><nav>menu</nav>", "x"),
             (103, "https://h.example/a/001?v=2", page(1), "x"), (None, "https://y.example/p", "<p>a &lt; b &amp;&nbsp;c", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert all(got[k].text == f"story {k} begins\nit ends {k}" and got[k].n_shared == 3 for k in range(2, 40))
    assert got[100].text == "" and got[101].text == "" and got[102].text == "alone" and got[None].text == "a < b & c"
    assert html_text.main_text(df.limit(0)).count() == 0


def test_rows_of_one_path_meet_other_pages(spark):
    def page(k):
        return f"<body><div>Our site</div><div>All about us</div><p>story {k} begins</p><p>it ends {k}</p><div>call now</div></body>"
    rows = [(k, f"https://s.example/index.php?id={k}&utm_source=x", page(k)) for k in range(1, 40)]  # one script path
    rows += [(100, "https://c.example/a", page(100)), (300, "https://c.example/c", page(300))]
    rows += [(200 + k, "https://c.example/b?ref=" + "xy"[k % 2], page(200)) for k in range(50)]  # copies of one URL
    rows += [(400, "https://v.example/a", page(400))]
    rows += [(500 + k, f"https://v.example/b?v={k}", page(500)) for k in range(30)]  # copies under many queries
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: (r.text, r.n_shared) for r in html_text.main_text(df).collect()}
    assert len(got) == len(rows)
    for k, _, page_html in rows:
        n = re.search(r"story (\d+)", page_html)[1]
        assert got[k] == (f"story {n} begins\nit ends {n}", 3), k


def test_rows_are_sent_and_kept_compressed(monkeypatch):
    words = [f"word{i}" for i in range(50)]
    texts = [" ".join(random.Random(k).choices(words, k=200)) for k in range(30)]
    pages = [f"<p>Our site</p><p>{t}</p><nav>menu</nav>" for t in texts]
    batch = pa.RecordBatch.from_pydict({
        "k": [f"h.example\x01/{k:02d}\x01\x01{k:020d}" for k in range(30)],
        "page_id": list(range(30)), "url": [f"https://h.example/{k:02d}" for k in range(30)], "html": pages})
    sent = list(html_text._parsed([batch.column("k")[0].as_py()], {})([batch]))
    assert sum(b.column("lines").nbytes for b in sent) < 0.6 * sum(map(len, texts))
    for held, on_disk in ((1 << 20, False), (1, True)):
        monkeypatch.setattr(html_text, "HELD", held)
        rows = html_text._Rows()
        for row in (r for b in sent for r in b.to_pylist()):
            rows.add(row)
        assert rows.file._rolled == on_disk and rows.at[-1] < 0.7 * sum(map(len, texts))
        got = [r for b in html_text._differenced(iter(sent)) for r in b.to_pylist()]
        assert [(r["text"], r["n_shared"], r["n_marked"]) for r in got] == [(t, 1, 1) for t in texts]


@pytest.mark.parametrize("box", ["article", "main"])
def test_differencing_judges_lines_inside_the_container(spark, box):
    def page(own, *more):
        lines = ["Share this story", *own, *more, "Read our newsletter"]
        return f"<body><div>site</div><{box}>" + "".join(f"<p>{x}</p>" for x in lines) + f"</{box}></body>"
    own = {k: [f"story {k} begins with its own words", f"and {k} goes on until it ends there"] for k in range(30)}
    own[7] = [*own[7], "a paragraph that the next page quotes"]
    own[8] = [*own[8], "a paragraph that the next page quotes"]
    rows = [(k, f"https://h.example/n/{k:03d}", page(own[k])) for k in own]
    copied = ["a long story that is copied as a whole by all pages of its host", "and that goes on for a second paragraph"]
    rows += [(100 + k, f"https://m.example/n/{k:03d}", page(copied, f"copy {k}")) for k in range(6)]
    rows += [(200 + k, f"https://two.example/n/{k}", page([f"only page {k} says this"])) for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: (r.text.split("\n"), r.n_shared, r.n_marked) for r in html_text.main_text(df).collect()}
    assert {k: got[k] for k in own} == {k: (v, 2, 1) for k, v in own.items()}
    for k in range(6):
        assert got[100 + k] == (["Share this story", *copied, f"copy {k}", "Read our newsletter"], 0, 1)
    assert all(got[200 + k][1] == 0 for k in range(2))  # one neighbour is not enough


def test_marked_boxes_are_not_main_text():
    page = ('<body><header>H</header><nav>m</nav><script>var t="</p>";</script><div class="ad-box">x</div><article><header><h1>T&amp;x</h1></header>'
            '<p>a<br>b <b>c</b><p class="notice">n<p>d &lt; e<form>f<input></form><div id="comments"><p>cc</div></article><aside>s</aside><footer>f')
    assert [t for z, t in html_text.lines_of(page) if z == html_text.ARTICLE] == ["T&x", "a b c", "d < e"]


@pytest.mark.parametrize("start, end", [
    ("<div class='layout has-sidebar'>", "</div>"), ("<div id='page-with-comments'>", "</div>"), ("<div class='widget'>", "</div>"),
    ("<form id='aspnetForm'>", "</form>"), ("<main class='no-sidebar'>", "</main>"), ("<div class='no-sidebar'><form>", "</form></div>")])
@pytest.mark.parametrize("article", ["<article>", "<article class='post category-social'>", "<article class='share'>", "<main>", "<div>"])
def test_marks_do_not_hide_the_text(start, end, article):
    close = "</" + article[1:-1].split()[0] + ">"
    page = f"<body><nav>menu</nav>{start}{article}<h1>title</h1><p>a long story</p><div class='comments'>c</div>{close}<footer>f</footer>{end}</body>"
    kept = [t for z, t in html_text.lines_of(page) if z != html_text.CHROME]
    assert kept == (["title", "a long story"] if article != "<div>" or "widget" not in start else [])


def test_marks_still_hide_boxes_beside_the_text():
    story = "<article><p>a story</p><div id='comments'><article class='comment'>c1</article><article>c2</article></div></article>"
    page = (f"<body>{story}<div class='related'><article>teaser, longer than the story</article></div><div class='site-footer'>f</div>"
            "<form>a search box, longer than</form></body>")
    assert [t for z, t in html_text.lines_of(page) if z == html_text.ARTICLE] == ["a story"]
    plain = "<p>an old page with its text</p><div class='related'><article>teaser</article></div><form>search</form>"
    assert [t for z, t in html_text.lines_of(plain) if z != html_text.CHROME] == ["an old page with its text"]


def vectors(rng, n, d=6):
    rows = []
    for k in range(n):
        v = rng.normal(size=d)
        if k % 3 == 0 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=d) * 0.12
        rows.append((k * 2 + 1, v.tolist(), int(k % 7 == 0)))
    return rows


def test_embedding_groups(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 300)
    rows += [(1001, rows[4][1], rows[4][2]), (1003, rows[4][1], rows[4][2]), (1005, None, 0), (1007, [0.0] * 6, 0), (1009, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0),
             (1011, [math.nan] * 6, 0), (1013, rows[4][1], None), (1015, [1.0, 2.0], 0), (1017, [2.0, 4.0], 0), (1019, [], 0),
             (1021, [1e300] * 6, 5), (1023, [1e300] * 6, 5), (1025, [1e-300] * 6, 5)]
    want = {}
    unit = {i: np.array(v) / np.abs(v).max() for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    label = {i: lab for i, _, lab in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    up = {i: i for i in label}
    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    for i in label:
        want[i] = (sum(i in link for link in links), top(i), top(i) == i)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows] + [(None, rows[4][1], rows[4][2], "x", 1)],
                               "vec_id long, embedding array<double>, label int, v string, n int")
    for tile in (2048, 16):
        got = {r.vec_id: tuple(r)[1:] for r in embedding.near_duplicates(df, tile=tile).collect()}
        assert got.pop(None) == (0, None, True)
        assert got == want
    assert embedding.near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(5, k) for k in range(100, 130)] + [(7, 7), (9, None), (3, 5), (5, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 20 for i in range(21, 61)}, **{k: 3 for k in range(100, 130)}, 5: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_follow_their_operators(spark, monkeypatch):
    from tests.llm.test_text_operators import base_spans, cut, groups

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dups", "passages", "pii", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("row", F.lit("r")).withColumn("score", F.lit(0.1))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(10**6).cast("long")))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(scratch(stage(spark, seen[-1], SF_SMALL)))
    good, single, passages, clean, packed = seen[1:]
    for step in (good, single, passages, clean):
        assert step.columns == docs.columns and step.dtypes == docs.dtypes
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rejected = docs.join(good, "doc_id", "left_anti").join(labels, "doc_id")
    assert rejected.where("quality = 1").count() <= 1
    pairs = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == {i for i, g in groups(pairs).items() if g[2]}
    before = [(r.doc_id, r.text) for r in single.collect()]
    after = {r.doc_id: r for r in passages.collect()}
    want = cut([p for p in before if p[1] is not None])
    assert set(after) == {i for i, _ in before}
    for i, t in before:
        if t is not None:
            assert re.findall(r"[^\x20\x09-\x0D]+", after[i].text) == want[i][3] and after[i].n_chars == len(after[i].text)
    for r in clean.collect():
        old = after[r.doc_id].text
        assert (r.text is None) == (old is None)
        if old is not None and not base_spans(old):
            assert r.text == old or "[" in r.text
        elif old is not None:
            assert r.text != old and not base_spans(r.text)
    assert packed.select("doc_id").distinct().count() == clean.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_pipeline_of_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, SF_SMALL))
    assert docs.count() == 0
