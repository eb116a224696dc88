"""Document fingerprints by a threshold-scaled sketch.

A text's sketch holds every word-shingle hash below a fixed fraction (1 / ``SCALE``) of the hash range, so
its size follows the text's, sketches of parts merge by union, and the share of one sketch found in
another estimates containment even between very unequal documents. A text with no hash below the bound
keeps its least hash, so that only texts without words have an empty sketch; such a hash is a name, not a
sample, and takes no part in likeness. Of texts with fewer than ``EXACT_BELOW`` shingles, which have too few
hashes below the bound, the likeness is taken with the fraction 1: all their hashes against all of the other
text's, in the pass that hashes both. A short text that another holds whole is so contained by 1.

``next_pairs`` streams documents in id order past their successors: ids are cut into ranges from
approximate quantiles, each range's first document is also sent to the range before it, and the last range
gets the very first document.

Defined cases: a null text is empty; two empty sketches are alike (1), an empty and another are not (0);
null ids come first; rows that repeat an id follow each other by text; other columns are ignored; no rows
give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WordHasher, doc_slices, shingle_sets, shuffle_partitions, string_buffer

SCALE = 8
SHINGLE = 5
EXACT_BELOW = 256  # shingles
_LEAST = -(2**63)


def shingle_hashes(column: pa.Array, hasher: WordHasher, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Per text all its distinct shingle hashes, sorted; ``hasher`` lower-cases A-Z."""
    out = []
    data, offsets = string_buffer(column)
    for i, j in doc_slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = hasher.split(part, offsets[i : j + 1] - offsets[i])
        out += shingle_sets(hasher.hashes(part, starts, ends), first, shingle)
    return out


def retained(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of a text: its hashes below the bound, or the least one if none is."""
    kept = hashes[: np.searchsorted(hashes, np.uint64((1 << 64) // scale))]
    # The top 48 bits are kept; the bound's share of the range is unchanged by that.
    return np.unique((kept if len(kept) else hashes[:1]) >> np.uint64(16))


def sketches(column: pa.Array, hasher: WordHasher, shingle: int = SHINGLE, scale: int = SCALE) -> list[np.ndarray]:
    """Per text its sorted retained hashes."""
    return [retained(s, scale) for s in shingle_hashes(column, hasher, shingle)]


def text_of(sketch: np.ndarray) -> str:
    """Twelve hex digits per retained hash, ascending."""
    return "".join(map("%012x".__mod__, sketch.tolist()))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def likeness(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """Share of text a's shingles that b has, from all hashes of both: exact for a short a, else by their sketches."""
    return containment(a, b) if len(a) < EXACT_BELOW else containment(retained(a, scale), retained(b, scale))


def edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _splits(cuts: list[float]) -> list[float]:
    """Cut points for a Bucketizer, which needs one cut at least."""
    return [-float("inf"), *(cuts or [float(2**62)]), float("inf")]


def _pairs(shingle: int, scale: int):
    def work(batches):
        hasher = WordHasher(lower=True)
        held = None  # the last row, which waits for its successor
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = list(zip(part.column("tail").to_pylist(), part.column("doc_id").to_pylist(), texts,
                                shingle_hashes(part.column("text"), hasher, shingle)))
                if held is not None:
                    rows.insert(0, held)
                held = rows[-1]
                steps = [(r, s) for r, s in zip(rows[:-1], rows[1:]) if not r[0]]
                new = [edited(r[2], s[2]) for r, s in steps]
                drawn = shingle_hashes(pa.array(new, pa.string()), hasher, shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[1] for r, _ in steps], pa.int64()), pa.array([len(r[2]) for r, _ in steps], pa.int64()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                     pa.array([text_of(retained(r[3], scale)) for r, _ in steps], pa.string()),
                     pa.array([text_of(retained(d, scale)) for d in drawn], pa.string()),
                     pa.array([likeness(r[3], d, scale) for (r, _), d in zip(steps, drawn)], pa.float64()),
                     pa.array([likeness(r[3], s[3], scale) for r, s in steps], pa.float64())],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return work


def next_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    doc_id = F.col(id_col).cast("long")
    order = F.coalesce(doc_id, F.lit(_LEAST))
    rows = docs.select(doc_id.alias("doc_id"), order.alias("k"), order.cast("double").alias("x"), F.col(text_col).cast("string").alias("text"))
    cuts = rows.approxQuantile("x", [i / (4 * parts) for i in range(1, 4 * parts)], 0.2 / parts)
    cut = Bucketizer(splits=_splits(sorted(set(cuts))), inputCol="x", outputCol="part")
    # One row per range: the number of ranges is bounded by the partition count.
    firsts = [r.k for r in cut.transform(rows.select("x", "k")).groupBy("part").agg(F.min("k").alias("k")).orderBy("part").collect()]
    if not firsts:
        firsts = [_LEAST]
    # Range i of those with rows starts at firsts[i]; its first row also ends range i - 1.
    heads = spark.createDataFrame([(k, (i - 1) % len(firsts)) for i, k in enumerate(firsts)], "k long, before int")
    ranges = Bucketizer(splits=_splits([float(k) for k in firsts[1:]]), inputCol="x", outputCol="part")
    dealt = ranges.transform(rows).join(F.broadcast(heads), "k", "left").select(
        "k", "doc_id", "text", F.explode(F.filter(F.array(
            F.struct(F.col("part").cast("int").alias("part"), F.lit(0).alias("tail")),
            F.struct(F.col("before").alias("part"), F.lit(1).alias("tail"))), lambda s: s["part"].isNotNull())).alias("s"),
    ).select("s.part", "s.tail", "k", "doc_id", "text")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "tail", "k", "text").select("tail", "doc_id", "text").mapInArrow(
        _pairs(shingle, scale), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
