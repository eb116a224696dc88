"""A training corpus from ``documents``: quality, near duplicates, repeated passages, personal data, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last return docs' own columns.

Every stage works on the rows its predecessor kept and never on labels of ids or sources:
    quality     rows that score under 0.5 go; without labels all rows stay
    near_dups   of each near-duplicate group the least doc_id stays; rows with a null id or no words stay
    passages    words covered by a 50-word run of a smaller document go; the row stays, even if empty
    pii         each span becomes its kind in brackets; null texts stay null
    packing     one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
``n_chars``, where docs has it, follows a changed text. Null texts count as empty; rows that repeat a
doc_id are one document; further columns pass through; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import minhash, packing, pii, quality, substring
from playlens.llm.common import scratch
from playlens.llm.queries import table, tokenizer_path


def _renewed(rows: DataFrame, columns: list[str], kinds: dict, changed) -> DataFrame:
    """docs' columns from (row, text): the new text, and n_chars where ``changed``."""

    def column(c: str):
        if c == "text":
            return F.col("text").alias(c)
        old = F.col("row").getField(c)
        return F.when(changed, F.length("text").cast(kinds[c])).otherwise(old).alias(c) if c == "n_chars" else old.alias(c)

    return rows.select(*[column(c) for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    cut = substring.repeated_passages(docs, carry=others).withColumnRenamed("kept_text", "text")
    return _renewed(cut, docs.columns, dict(docs.dtypes), F.col("n_removed") > 0)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pii.train(docs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), pii.redacted(docs["text"], model).alias("text"))
    return _renewed(rows, docs.columns, dict(docs.dtypes), ~F.col("text").eqNullSafe(F.col("row.text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES = [
    ("quality", keep_quality),
    ("near_dups", drop_near_duplicates),
    ("passages", cut_repeated_passages),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]

# A learned classifier, learned spans and an evolved packing have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir))
    return docs
