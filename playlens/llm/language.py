"""Language ID by language-bitmask n-gram filters.

Every letter of a text gives one n-gram: itself with its two neighbours, lower-cased, blanks where a neighbour
is no letter or mark. Three code points of 21 bits make an exact 63-bit key.

Training counts each n-gram per language over all training texts. A language contains an n-gram if at least
``LEAST_RATE`` of the language's n-grams are this one, and no other language has it more than ``RATIO`` times
as often, by rate. A language thus contains 1 / LEAST_RATE n-grams at most, however much text there is, and
the filter has a fixed size.

The filter is bit-sliced: each of ``SLOTS`` slots holds one bit per language, an n-gram sets its languages'
bits in ``HASHES`` slots, and the AND of those slots gives all languages that contain it in one reading.
Per text and language the n-grams found are counted (c of t). A share f of absent ones is found by chance,
f = (filled share of the language's slice) ^ HASHES, so (c - t f) / (1 - f) of them are truly contained; the
language with the most wins, a tie goes to the one with more training text.

Defined cases: a null text, or one without letters, is ``und`` with score 0; so is every text if nothing is
learned; a text none of whose n-grams is known goes to the language with the most training text, score 0;
rows without a language or id are not learned from (a null id is not held out); rows that repeat count again
and are scored each; very long texts are read whole, in slices; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import doc_slices, mix, scratch, string_buffer

SLOTS = 1 << 20
HASHES = 3
LEAST_RATE = 1e-5
RATIO = 8.0
UNKNOWN = "und"


class Folder:
    """Code points as they count in n-grams: lower case, 0 for what is neither letter nor mark."""

    def __init__(self):
        self.folded = np.full(0x110000, -1, np.int32)
        self.letter = np.zeros(0x110000, bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        for c in np.unique(points[self.folded[points] < 0]).tolist():
            ch = chr(c)
            low = ch.lower()
            self.letter[c] = ch.isalpha()
            self.folded[c] = 0 if not ch.isalpha() and unicodedata.category(ch)[0] != "M" else ord(low) if len(low) == 1 else c
        return self.folded[points]


def ngrams(data: np.ndarray, offsets: np.ndarray, fold: Folder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all n-gram keys, index of each document's first, whether a document has a letter)."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    head = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=head[1:])
    bounds = head[offsets]
    if len(points) == 0:
        return np.zeros(0, np.int64), bounds, np.zeros(len(offsets) - 1, bool)
    f = fold(points).astype(np.int64)
    left, right = np.concatenate([[0], f[:-1]]), np.concatenate([f[1:], [0]])
    left[bounds[:-1][bounds[:-1] < len(f)]] = 0
    right[bounds[1:] - 1] = 0
    some = f != 0

    def before(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[bounds]

    keys = (left[some] << 42) | (f[some] << 21) | right[some]
    return keys, before(some), np.diff(before(fold.letter[points])) > 0


def slots(keys: np.ndarray) -> list[np.ndarray]:
    h = mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(20 * i)) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, c) over all (lang, text) rows; each task sends a pair once per batch."""

    def work(batches):
        fold = Folder()
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column("lang")))
            langs = batch.column("lang").to_pylist()
            data, offsets = string_buffer(batch.column("text"))
            parts = []
            for i, j in doc_slices(offsets):
                keys, first, _ = ngrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], fold)
                at = i
                while at < j:
                    end = at + 1
                    while end < j and langs[end] == langs[at]:
                        end += 1
                    grams, c = np.unique(keys[first[at - i] : first[end - i]], return_counts=True)
                    parts.append(pa.table({"lang": pa.array([langs[at]] * len(grams), pa.string()), "gram": grams, "c": c}))
                    at = end
            if parts:
                whole = pa.concat_tables(parts).group_by(["lang", "gram"]).aggregate([("c", "sum")])
                yield from whole.select(["lang", "gram", "c_sum"]).rename_columns(["lang", "gram", "c"]).to_batches()

    return rows.mapInArrow(work, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def contained(counts: DataFrame, totals: DataFrame, least_rate: float = LEAST_RATE, ratio: float = RATIO) -> DataFrame:
    """(gram, bit): the languages that contain each n-gram; ``totals`` is (lang, bit, total)."""
    rated = counts.join(totals, "lang").select("gram", "bit", (F.col("c") / F.col("total")).alias("rate"))
    by_gram = rated.where(F.col("rate") >= least_rate).groupBy("gram").agg(  # a list is as long as there are languages
        F.collect_list(F.struct("bit", "rate")).alias("held"), F.max("rate").alias("top"))
    return by_gram.select("gram", F.explode(F.filter("held", lambda x: x["rate"] * ratio >= F.col("top"))).alias("x")).select("gram", "x.bit")


@dataclass
class Model:
    """The bit-sliced filter: a row of slots per 64 languages, and per language its chance of a false find."""

    langs: list[str]
    filter: list[np.ndarray]
    false_rate: np.ndarray

    def found(self, keys: np.ndarray) -> list[np.ndarray]:
        """Masks of the languages that contain each n-gram: one array per 64 languages."""
        at = slots(keys)
        out = []
        for words in self.filter:
            mask = words[at[0]]
            for s in at[1:]:
                mask &= words[s]
            out.append(mask)
        return out


def _set_bits(batches):
    """(word, slot, mask) with the bits of one batch's n-grams joined."""
    for batch in batches:
        keys, bit = batch.column("gram").to_numpy(), batch.column("bit").to_numpy()
        at = np.concatenate(slots(keys))
        bits = np.tile(bit, HASHES).astype(np.int64)
        cell, place = np.unique((bits // 64) * SLOTS + at, return_inverse=True)
        mask = np.zeros(len(cell), np.uint64)
        np.bitwise_or.at(mask, place, np.uint64(1) << (bits % 64).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(mask.view(np.int64))], names=["cell", "mask"])


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all rows that have a language."""
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null")
    counts = scratch(ngram_counts(rows))
    sums = sorted(counts.groupBy("lang").agg(F.sum("c").alias("total")).collect(), key=lambda r: (-r.total, r.lang))  # a row per language
    langs = [r.lang for r in sums]
    if not langs:
        return Model([], [], np.zeros(0))
    totals = rows.sparkSession.createDataFrame([(r.lang, i, r.total) for i, r in enumerate(sums)], "lang string, bit int, total long")
    cells = contained(counts, totals).mapInArrow(_set_bits, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask"))
    got = cells.toArrow()  # at most SLOTS rows per 64 languages
    whole = np.zeros(-(-len(langs) // 64) * SLOTS, np.uint64)
    whole[got.column("cell").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    fill = [float(np.count_nonzero(whole[i // 64 * SLOTS : (i // 64 + 1) * SLOTS] >> np.uint64(i % 64) & np.uint64(1))) / SLOTS
            for i in range(len(langs))]
    narrow = next((t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(langs) <= n), np.uint64)
    return Model(langs, [w.astype(narrow) for w in whole.reshape(-1, SLOTS)], np.array(fill) ** HASHES)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row; score is the share of the n-grams that the language contains."""
    # A broadcast is pickled by reference, so it holds arrays only; the class goes with the function.
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.filter, model.false_rate))

    def work(batches):
        model, fold = Model(*shared.value), Folder()
        names = pa.array([*model.langs, UNKNOWN], pa.string())
        for batch in batches:
            data, offsets = string_buffer(batch.column("text"))
            best, score = np.full(batch.num_rows, len(model.langs)), np.zeros(batch.num_rows)
            for i, j in doc_slices(offsets) if model.langs else ():
                keys, first, letters = ngrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], fold)
                t = np.diff(first)
                masks = model.found(keys)
                held = np.empty((j - i, len(model.langs)))
                for b, f in enumerate(model.false_rate):
                    sums = np.zeros(len(keys) + 1, np.int64)
                    word = masks[b // 64]
                    np.cumsum((word >> word.dtype.type(b % 64)) & word.dtype.type(1), out=sums[1:])
                    held[:, b] = (np.diff(sums[first]) - t * f) / max(1 - f, 1e-12)
                top = np.argmax(held, axis=1)
                share = np.clip(held[np.arange(j - i), top] / np.maximum(t, 1), 0, 1)
                best[i:j] = np.where(letters, np.where(share > 0, top, 0), len(model.langs))
                score[i:j] = np.where(letters, share, 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), names.take(pa.array(best)), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        work, "doc_id long, lang_pred string, score double")
