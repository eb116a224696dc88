"""Spelling variant grouping by asymmetric q-chunks.

Words one edit apart are found by a join of unequal sides. The longer word of a pair gives two disjoint
chunks, its front and its back half; the other word gives positional grams of the same lengths. One edit
touches one half only, so the other half stands in the shorter word: a front half at its own place, a back
half shifted by the difference of the lengths, that is by one at most. Of all positional grams only those
are sent that such a chunk can meet.

Chunks that many words share (``HOT`` or more) would make their group's join quadratic. Their words are cut
once more by the same rule: the half that holds the edit gives two chunks of its own, and the key is the
common half with one of them. Every candidate is verified in the join itself, so only links leave it. A
pair that both chunks find is taken from the front one. All sides grow with the vocabulary, and Spark takes the
compressed file of words for the size of its exploded chunks, so no join here may broadcast one.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased (A-Z only). Occurrences can be altered
on purpose: where ``EVERY`` divides the crc32 of ``<doc_id>:<run>``, one code point goes (``altered=True``).

Defined cases: a null text has no words; a null id counts as an empty one in the crc32; rows that repeat
count again; very long texts and runs are read whole; ties of ``n`` go to the word that is least in code-point
order; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.broadcast import never_broadcast
from playlens.llm.common import doc_slices, scratch, string_buffer
from playlens.llm.tokens import byte_class, runs_of, strings

EVERY = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10  # a form occurs at least this many times as often
HOT = 64  # words of one chunk from which on the second cut is made
_LONG_RUN = 64  # bytes from which on a run's crc32 is taken alone

_LETTER = byte_class((65, 90), (97, 122))
_HIGH = 0xC3  # the lead byte of U+00C0 to U+00FF, and of nothing else


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> 1) ^ np.where(t & 1, np.uint32(0xEDB88320), np.uint32(0))
    return t


def run_crcs(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run continued from ``before``: all runs advance by one byte at a time."""
    table = _crc_table()
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    state = ~before.astype(np.uint32)[order]
    at = starts[order]
    reach = np.searchsorted(-size[order], -np.arange(_LONG_RUN + 1), "left")  # runs longer than p bytes
    for p in range(_LONG_RUN):
        k = int(reach[p])
        if k == 0:
            break
        s = state[:k]
        state[:k] = table[(s ^ lowered[at[:k] + p]) & 255] ^ (s >> 8)
    out = np.empty(len(starts), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(size > _LONG_RUN):
        out[i] = zlib.crc32(lowered[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def slice_words(data: np.ndarray, offsets: np.ndarray, ids: list, altered: bool, least_length: int) -> pa.Array:
    """All words of at least ``least_length`` code points in a few documents, repeats included."""
    lead = data == _HIGH
    ink = _LETTER[data] | lead
    ink[1:] |= lead[:-1]
    starts, ends, first = runs_of(ink, offsets)
    heads = (data & 0xC0) != 0x80
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(heads, out=points[1:])
    size = points[ends] - points[starts]
    keep = None
    if altered and len(starts):
        seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        crc = run_crcs(lowered, starts, ends, np.repeat(seeds, np.diff(first))).astype(np.int64)
        hit = np.flatnonzero(crc % EVERY == 0)
        gone = np.flatnonzero(heads)[points[starts[hit]] + crc[hit] % size[hit]]
        keep = np.ones(len(data), bool)
        keep[gone] = False
        wide = gone[data[gone] == _HIGH]
        keep[wide + 1] = False
        size[hit] -= 1
    chosen = size >= least_length
    return strings(data, starts[chosen], ends[chosen], keep)


def word_counts(docs: DataFrame, altered: bool = False, least_length: int = LEAST_LENGTH,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): occurrences over all texts; each task sends a word once per batch."""

    def work(batches):
        for batch in batches:
            data, offsets = string_buffer(batch.column("text"))
            ids = batch.column("id").to_pylist()
            parts = [slice_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ids[i:j], altered, least_length)
                     for i, j in doc_slices(offsets)]
            if parts:
                counts = pa.chunked_array(parts).value_counts()
                yield pa.RecordBatch.from_arrays(
                    [counts.field("values").cast(pa.string()), counts.field("counts")], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _chunks(words: DataFrame) -> DataFrame:
    """(word, n, size, side, chunk, edited): the two disjoint chunks of each word; ``edited`` is the other half."""
    size = F.char_length("word")
    h = (size / 2).cast("int")
    front, back = F.substring("word", F.lit(1), h), F.substring("word", h + 1, size - h)
    return words.select("word", "n", size.alias("size"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), front.alias("chunk"), back.alias("edited")),
        F.struct(F.lit(1).alias("side"), back.alias("chunk"), front.alias("edited")),
    )).alias("c")).select("word", "n", "size", "c.*")


def _grams(words: DataFrame) -> DataFrame:
    """(word, n, size, side, chunk, edited): positional grams for chunks of words as long, and one longer."""
    own = F.char_length("word")
    word = F.col("word")

    def of(size: Column) -> list[Column]:
        h = (size / 2).cast("int")
        back = h + own - size  # where the back half begins: shifted by the difference of the lengths
        left, right = F.substring(word, F.lit(1), h), F.substring(word, back + 1, size - h)
        return [
            F.struct(size.alias("size"), F.lit(0).alias("side"), left.alias("chunk"), F.substring(word, h + 1, own - h).alias("edited")),
            F.struct(size.alias("size"), F.lit(1).alias("side"), right.alias("chunk"), F.substring(word, F.lit(1), back).alias("edited")),
        ]

    return words.select("word", "n", F.explode(F.array(*of(own), *of(own + 1))).alias("g")).select("word", "n", "g.*")


def _verified() -> Column:
    """The pair is one edit apart, and this chunk is the one to report it."""
    x, y = F.col("x.word"), F.col("y.word")
    same = F.col("x.size") == F.char_length(y)
    # Of two words of one length each is in both sides; the front chunk reports what both chunks find.
    once = (~same | (x < y)) & ((F.col("x.side") == 0) | (F.left(y, F.char_length(F.col("x.edited"))) != F.col("x.edited")))
    return once & (F.levenshtein(F.col("x.edited"), F.col("y.edited"), 1) == 1)


def _recut(rows: DataFrame) -> DataFrame:
    """The second cut, of the half that holds the edit: ``sub`` is a chunk of it (or a gram that can meet one)."""
    edited = F.col("edited")
    own = F.char_length("edited")
    size = own + F.col("size") - F.char_length("word")  # of that half in the longer word; it tells where the chunks lie
    h = (size / 2).cast("int")
    back = h + own - size
    subs = F.array(F.struct(F.lit(0).alias("part"), F.substring(edited, F.lit(1), h).alias("sub")),
                   F.struct(F.lit(1).alias("part"), F.substring(edited, back + 1, size - h).alias("sub")))
    return rows.select("*", F.explode(subs).alias("s")).select(*rows.columns, "s.*")


def links(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, na, b, nb): each pair of words one edit apart once; ``words`` is (word, n) with distinct words."""
    chunks, grams = _chunks(words), _grams(words)
    key = ["size", "side", "chunk"]
    crowded = never_broadcast(scratch(chunks.groupBy(*key).agg(F.count("*").alias("c")).where(F.col("c") >= hot).drop("c")))

    def pairs(x: DataFrame, y: DataFrame, on: list[str], also=None) -> DataFrame:
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on]
        keep = _verified() if also is None else _verified() & also
        x, y = x.alias("x"), y.alias("y")
        for c in same:
            keep = c & keep
        return x.join(never_broadcast(y), keep).select(F.col("x.word").alias("a"), F.col("x.n").alias("na"),
                                      F.col("y.word").alias("b"), F.col("y.n").alias("nb"))

    few = pairs(chunks.join(crowded, key, "left_anti"), grams, key)
    # Of two sub-chunks that both find a pair, the front one reports it.
    first = (F.col("x.part") == 0) | (F.left(F.col("y.edited"), F.char_length("x.edited") - F.char_length("x.sub")) !=
                                     F.left(F.col("x.edited"), F.char_length("x.edited") - F.char_length("x.sub")))
    many = pairs(_recut(chunks.join(crowded, key, "left_semi")), _recut(grams.join(crowded, key, "left_semi")),
                 [*key, "part", "sub"], first)
    return few.unionByName(many)


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) from (word, form) by pointer doubling.

    Each form occurs ``FORM_RATIO`` times as often as its word, so a chain has at most log(most) steps.
    """
    now = forms.select("word", F.col("form").alias("root"))
    steps = max(1, math.ceil(math.log(max(most, 2), FORM_RATIO)))
    for _ in range(math.ceil(math.log2(steps + 1))):
        now = scratch(now)
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.join(never_broadcast(on), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for (word, n) rows of distinct words."""
    words = scratch(words.select("word", F.col("n").cast("long").alias("n")))
    found = scratch(links(words, hot))
    near = found.unionByName(found.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = near.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("w"))).alias("best"))
    rows = scratch(words.join(never_broadcast(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.m") >= FORM_RATIO * F.col("n"), F.struct(F.col("best.w").alias("w"), (-F.col("best.m")).alias("m"))).alias("f"),
    ).select("word", F.col("f.w").alias("form"), "n", "n_near", F.col("f.m").alias("form_n")))
    most = rows.agg(F.max("n")).first()[0] or 1
    return rows.join(never_broadcast(roots(rows.where("form is not null"), most)), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, altered: bool = False, id_col: str = "doc_id", text_col: str = "text",
                      least_count: int = LEAST_COUNT, least_length: int = LEAST_LENGTH) -> DataFrame:
    """Variants among the words of all texts that occur at least ``least_count`` times."""
    return variants(word_counts(docs, altered, least_length, id_col, text_col).where(F.col("n") >= least_count))
