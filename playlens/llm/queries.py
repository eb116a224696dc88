"""Registered queries of the operators: thin digests of what the operators return.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, DuckDB SQL or None)``. SQL is given where it can
say the whole result; the other queries are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import embedding, fingerprint, html_text, language, lexical, lm, minhash, packing, pii, quality, segmentation, spelling, substring

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def wrap(build):
        QUERIES[name] = (build, sql)
        return build

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.next_pairs(table(spark, sf_dir, "documents"))


# The recursive part of each component query walks links from every row to the least id it reaches.
_COMPONENTS = """
    near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    walk(node, root) AS (
        SELECT a, a FROM near
        UNION
        SELECT near.b, walk.root FROM walk JOIN near ON near.a = walk.node WHERE walk.root < near.b
    ),
    least AS (SELECT node, min(root) AS root FROM walk GROUP BY node)
"""

OP4_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    wins AS (
        SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM words WHERE len(ws) >= 50)
    ),
    least AS (SELECT k, min(doc_id) AS m FROM wins GROUP BY k),
    cut AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM wins JOIN least USING (k) WHERE m < doc_id),
    gone AS (SELECT doc_id, list(p) AS ps FROM cut GROUP BY doc_id),
    kept AS (
        SELECT words.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
            CASE WHEN ps IS NULL THEN ws ELSE list_filter(
                list_transform(range(1, len(ws) + 1), lambda i: CASE WHEN list_contains(ps, i) THEN NULL ELSE ws[i] END),
                lambda w: w IS NOT NULL) END AS ks
        FROM words LEFT JOIN gone USING (doc_id)
    )
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256 FROM kept
"""


@query("op4_repeated_passages", OP4_SQL)
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_lm_scores")
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = quality.held_out("doc_id", 7, 2)
    return lm.scores(table(spark, sf_dir, "documents"), ~held).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP6_SQL = (
    r"""
WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS ws FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 75 * (p.n + q.n - c)
    ),
"""
    + _COMPONENTS
    + """
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, least(coalesce(root, words.doc_id), words.doc_id) AS component_id,
    least(coalesce(root, words.doc_id), words.doc_id) = words.doc_id AS kept
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.node = words.doc_id
"""
)


@query("op6_minhash_groups", OP6_SQL)
def op6_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pii.train(docs)
    found = docs.select("doc_id", pii.spans(F.col("text"), model).alias("found"))
    base = F.col("found.base")

    def count(kind: int):
        return F.size(F.filter(base, lambda c: c["k"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("found.spans")).alias("spans"))


OP10_SQL = (
    """
WITH RECURSIVE vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    good AS (
        SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors
        WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(v, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id
        WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.93
    ),
"""
    + _COMPONENTS
    + """
    , degree AS (SELECT a AS node, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(coalesce(root, vec_id), vec_id) AS component_id,
    least(coalesce(root, vec_id), vec_id) = vec_id AS kept
FROM vectors LEFT JOIN degree ON degree.node = vec_id LEFT JOIN least ON least.node = vec_id
"""
)


@query("op10_embedding_groups", OP10_SQL)
def op10_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
        SELECT list(v ORDER BY b) AS t FROM (
            SELECT b, list_reduce(list_prepend(b, range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
            FROM (SELECT unnest(range(256)) AS b))
    ),
    runs AS (
        SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS c
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY 1, 2
    ),
    coded AS (SELECT r, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS h FROM runs),
    hashed AS (
        SELECT r, c, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
            lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h
        FROM coded CROSS JOIN crc_table
    ),
    changed AS (
        SELECT CASE WHEN h % 31 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, c FROM hashed
    ),
    words AS (
        SELECT word, CAST(sum(c) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
    ),
    holes AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    one AS (
        SELECT x.word, y.word AS near, y.n AS m FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
        UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word
    ),
    best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM one GROUP BY word),
    formed AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best.m >= 10 * n THEN best.m END AS form_n,
            CASE WHEN best.m >= 10 * n THEN (SELECT min(near) FROM one WHERE one.word = words.word AND one.m = best.m) END AS form
        FROM words LEFT JOIN best USING (word)
    ),
    walk(word, root) AS (
        SELECT word, word FROM formed
        UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL
    ),
    last AS (SELECT walk.word, root FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""


@query("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), altered=True)


OP12_SQL = r"""
WITH terms AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
    ),
    asked AS (
        SELECT item_id, t, count(*) AS q FROM (
            SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY 1, 2
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM sizes),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM terms WHERE t IN (SELECT t FROM asked) GROUP BY 1, 2),
    w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
          FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) CROSS JOIN whole),
    impact AS (
        SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l)) AS x
        FROM tf JOIN sizes USING (doc_id) CROSS JOIN whole
    ),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(q * w * x) AS BIGINT) AS score FROM asked JOIN w USING (t) JOIN impact USING (t) GROUP BY 1, 2
    )
SELECT * FROM (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0)
WHERE rank <= 10
"""


@query("op12_ranked_search", OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_language")
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality.held_out("doc_id", 5, 0)
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~held))
    return language.predict(docs, model).select("doc_id", quality.held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def queries() -> dict:
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in QUERIES.items() if v[1]}
