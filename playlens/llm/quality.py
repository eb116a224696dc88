"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of the whole text is cut into quantile bins. Cyclic boosting visits the features in turn
and adds a shallow tree over that feature's bins to its lookup table; then the pairs with the best
two-cut gain on the residuals are boosted the same way over coarser bins. A score is the sum of table
entries (vectorised look-ups per batch) through the logistic function.

The model is fitted on at most ``MAX_FIT_ROWS`` labelled rows, those with the least hash of the id, so the
fit has a fixed size; scoring covers every row and whole texts.

Defined cases: a null text scores as an empty one; labels other than 0 and 1 and labels without a
document are ignored; without labels every score is 0.5; a null id is never trained on and is not held
out; rows that repeat are scored each; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WordHasher, doc_slices, string_buffer, window_hashes

MAX_FIT_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 60
PAIR_ROUNDS = 30
RATE = 0.2

FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "symbols", "exclaim", "non_ascii", "spaces", "distinct_words",
    "top_word", "same_next", "repeated_runs", "line_stops", "line_words", "symbol_ends", "short_words",
    "single_bytes", "longest_word",
)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars)] = 1
    return t


_LETTERS = _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(b"0123456789")
_SYMBOL = _table(b"#$%&*+/<=>@[\\]^_`{|}~")
_EXCLAIM = _table(b"!?")
_WIDE = _table(bytes(range(128, 256)))
_SPACE = _table(b" \t\n\r\x0b\x0c")
_STOP = _table(b".!?")


def text_features(batch_column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    hasher = WordHasher(lower=True)
    data, offsets = string_buffer(batch_column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i, j in doc_slices(offsets):
        _slice_features(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], out[i:j])
    return out


def _slice_features(hasher: WordHasher, data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    if len(data) == 0:
        return

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, first = hasher.split(data, offsets)
    words = hasher.hashes(data, starts, ends)
    count = np.diff(first)
    size = np.maximum(np.diff(offsets), 1)
    some = np.maximum(count, 1)
    length = ends - starts

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[first[1:]] - sums[first[:-1]]

    spaces = per_doc(_SPACE[data])
    out[:, 0] = np.log1p(count)
    out[:, 1] = per_word(length) / some
    out[:, 2] = per_doc(_UPPER[data]) / np.maximum(per_doc(_LETTERS[data]), 1)
    out[:, 3] = per_doc(_DIGIT[data]) / size
    out[:, 4] = per_doc(_SYMBOL[data]) / size
    out[:, 5] = per_doc(_EXCLAIM[data]) / size
    out[:, 6] = per_doc(_WIDE[data]) / size
    out[:, 7] = spaces / size
    out[:, 14] = per_word(_SYMBOL[data[ends - 1]] + _EXCLAIM[data[ends - 1]]) / some
    out[:, 15] = per_word((length <= 3).astype(np.int64)) / some
    out[:, 16] = per_word((length == 1).astype(np.int64)) / some
    # Lines: ends are newlines and the ends of the documents.
    newline = data == 10
    lines = per_doc(newline) + 1
    before = np.zeros(len(data), np.int64)
    before[1:] = _STOP[data[:-1]]
    last = np.where(np.diff(offsets) > 0, _STOP[data[np.maximum(offsets[1:] - 1, 0)]], 0)
    out[:, 12] = (per_doc(before * newline) + last) / lines
    out[:, 13] = np.log1p(count / lines)
    full = window_hashes(words, 5)
    for d in np.flatnonzero(count):
        a, b = first[d], first[d + 1]
        own = words[a:b]
        _, times = np.unique(own, return_counts=True)
        out[d, 8] = len(times) / (b - a)
        out[d, 9] = times.max() / (b - a)
        out[d, 17] = np.log1p(length[a:b].max())
        if b - a > 1:
            out[d, 10] = (own[1:] == own[:-1]).mean()
        if b - a >= 5:
            out[d, 11] = 1 - len(np.unique(full[a : b - 4])) / (b - a - 4)


@dataclass
class Model:
    """Lookup tables: ``base`` plus one entry per feature bin and per pair of coarse bins."""

    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, table)
    coarse: list = field(default_factory=list)  # feature bin -> coarse bin

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges:
            b = self.bins(x)
            for f, t in enumerate(self.tables):
                total += t[b[:, f]]
            for f, g, t in self.pairs:
                total += t[self.coarse[f][b[:, f]], self.coarse[g][b[:, g]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, cut) of the best split of ordered bins; cut 0 means none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    if len(gain) == 0:
        return 0.0, 0
    k = int(np.argmax(gain))
    return float(gain[k]), (k + 1 if gain[k] > 1e-9 else 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a shallow tree over ordered bins."""
    cut = _best_cut(g, h)[1] if depth else 0
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values) of one cut on the first feature and one on the second in each half."""
    best, leaf = -1.0, np.zeros_like(g)
    for cut in range(1, len(g)):
        value = np.empty_like(g)
        gain = -g.sum() ** 2 / (h.sum() + 1)
        for part in (slice(None, cut), slice(cut, None)):
            gs, hs = g[part].sum(0), h[part].sum(0)
            more, k = _best_cut(gs, hs)
            gain += more + gs.sum() ** 2 / (hs.sum() + 1)
            k = k or len(gs)
            for side in (slice(None, k), slice(k, None)):
                value[part, side] = gs[side].sum() / (hs[side].sum() + 1)
        if gain > best:
            best, leaf = gain, value
    return best, leaf


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the feature tables, then of the strongest pairs."""
    if len(y) == 0:
        return Model()
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Model(base=float(np.log(mean / (1 - mean))))
    for f in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])))
    b = model.bins(x)
    width = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(w) for w in width]
    model.coarse = [np.arange(w) * min(PAIR_BINS, w) // w for w in width]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, w in enumerate(width):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, f], g, w), np.bincount(b[:, f], h, w))
            model.tables[f] += step
            total += step[b[:, f]]

    def grid(f: int, k: int, v: np.ndarray) -> np.ndarray:
        m = model.coarse[k][-1] + 1
        n = model.coarse[f][-1] + 1
        return np.bincount(model.coarse[f][b[:, f]] * m + model.coarse[k][b[:, k]], v, n * m).reshape(n, m)

    g, h = slopes()
    ranked = sorted(((-_pair_tree(grid(f, k, g), grid(f, k, h))[0], f, k)
                     for f in range(len(width)) for k in range(f + 1, len(width))))
    model.pairs = [(f, k, np.zeros((model.coarse[f][-1] + 1, model.coarse[k][-1] + 1))) for _, f, k in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for f, k, table in model.pairs:
            g, h = slopes()
            step = RATE * _pair_tree(grid(f, k, g), grid(f, k, h))[1]
            table += step
            total += step[model.coarse[f][b[:, f]], model.coarse[k][b[:, k]]]
    return model


def held_out(id_col: str | Column, of: int = 3, remainder: int = 1) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % of == remainder, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = MAX_FIT_ROWS) -> Model:
    """A model from the labelled rows that are not held out, at most ``max_rows`` of them."""
    key = F.col(id_col).cast("long")
    chosen = (
        labels.select(key.alias("k"), F.col(label_col).cast("int").alias("y"))
        .where("y in (0, 1) and k is not null").where(~held_out("k"))
        .orderBy(F.xxhash64("k"), "k", "y").limit(max_rows)
    )

    def work(batches):
        for batch in batches:
            x = text_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("y"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["k", "y", "x"])

    rows = (
        docs.select(key.alias("k"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "k")  # at most max_rows rows
        .select("k", "y", "text").mapInArrow(work, "k long, y int, x array<double>")
        .orderBy(F.xxhash64("k"), "k", "y").limit(max_rows).collect()
    )
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.y for r in rows], float))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row of ``docs``."""

    def work(batches):
        for batch in batches:
            score = model.score(text_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        work, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    at = docs.columns.index(text_col)

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(text_features(batch.column(at))) >= threshold))

    return docs.mapInArrow(work, docs.schema)
