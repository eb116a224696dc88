"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood bigram, unigram and uniform estimates. The mixture weights depend on
how often the context word occurs (one bucket per power of two) and are learned by expectation-
maximisation on held-out counts: every training token is left out of its own counts (the deleted
estimate), so all training text counts and all of it judges the weights.

1. Texts are dealt to batches of about ``BATCH_BYTES`` by a hash. A batch sends each of its distinct
   n-grams once, with its training count, to the n-gram's bucket (arrays of hashes, pre-aggregated, so a
   frequent word costs one entry per batch).
2. A bucket sums the counts and returns each batch its totals in the order sent.
3. A batch writes, per document, the corpus counts of its tokens and bigrams. Everything after reads that
   table: training size and vocabulary, the held-out statistics (a histogram of estimate ratios per
   context bucket, bounded by its grid), and the scores.

Defined cases: a null text is empty, which is the end token alone; without training text every estimate is
uniform; a null id trains and is not held out; rows that repeat count and score each; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WordHasher, doc_slices, mix, runs, scratch, shuffle_partitions, string_buffer

BATCH_BYTES = 8 << 20  # texts that one group of rows works on
BUCKET_BYTES = 16 << 20  # texts per bucket of n-grams
EM_STEPS = 60
GRID = 0.25  # width in nats of the histogram's bins
_U = np.uint64
_BEGIN, _END = _U(0x1F83D9ABFB41BD6B), _U(0x5BE0CD19137E2179)


def _pack(x: np.ndarray) -> bytes:
    """A byte per count; counts from 255 on follow in 4 (or, if one needs it, 8) bytes each."""
    big = x[x >= 255]
    wide = np.uint32 if len(big) == 0 or big.max() < 1 << 32 else np.uint64
    return np.minimum(x, 255).astype(np.uint8).tobytes() + big.astype(wide).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    small = np.frombuffer(raw, np.uint8, n)
    out = small.astype(np.int64)
    at = np.flatnonzero(small == 255)
    if len(at):
        out[at] = np.frombuffer(raw, np.uint32 if len(raw) - n == 4 * len(at) else np.uint64, offset=n)
    return out


def _tokens(column, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words and end marks, the token before each, first token per text) of a column of texts."""
    words, counts = [], []
    data, offsets = string_buffer(column)
    for i, j in doc_slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = hasher.split(part, offsets[i : j + 1] - offsets[i])
        words.append(hasher.hashes(part, starts, ends))
        counts.append(np.diff(first))
    count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(count + 1)])
    flat = np.full(first[-1], _END)
    body = np.ones(first[-1], bool)
    body[first[1:] - 1] = False
    if words:
        flat[body] = np.concatenate(words)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[first[:-1]] = _BEGIN
    return flat, before, first


def _pairs(flat: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(before * _U(0xD6E8FEB86659FD93) + flat)


def _trained(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, how often each is a training token); no index of the tokens is made."""
    one = np.unique(keys)
    seen, times = np.unique(keys[train], return_counts=True)
    out = np.zeros(len(one), np.int64)
    out[np.searchsorted(one, seen)] = times
    return one, out


def _bounds(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, an equal part of the hash range, starts."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(sorted_hashes, np.array(edges, np.uint64)), [len(sorted_hashes)]]).astype(int)


def _low48(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _send(buckets: int):
    """Rows (bucket, batch, words, word counts, bigrams, bigram counts) of each batch's distinct n-grams."""

    def work(batches):
        hasher = WordHasher(lower=True)
        for group in runs(batches, ["batch"]):
            flat, before, first = _tokens(group.column("text"), hasher)
            train = np.repeat(np.asarray(group.column("train")).astype(bool), np.diff(first))
            batch = group.column("batch")[0].as_py()
            del group
            one, n1 = _trained(flat, train)
            pairs = _pairs(flat, before)
            del flat, before
            two, n2 = _trained(pairs, train)
            del pairs
            b1, b2 = _bounds(one, buckets), _bounds(two, buckets)
            some = np.flatnonzero((np.diff(b1) > 0) | (np.diff(b2) > 0)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([batch] * len(some), pa.int32()),
                 pa.array([one[b1[b] : b1[b + 1]].tobytes() for b in some], pa.binary()),
                 pa.array([_pack(n1[b1[b] : b1[b + 1]]) for b in some], pa.binary()),
                 pa.array([_low48(two[b2[b] : b2[b + 1]]) for b in some], pa.binary()),
                 pa.array([_pack(n2[b2[b] : b2[b + 1]]) for b in some], pa.binary())],
                names=["bucket", "batch", "h1", "n1", "h2", "n2"])

    return work


def _totals(keys: list[np.ndarray], counts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    one = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    total = np.zeros(len(one), np.int64)
    for k, c in zip(keys, counts):  # distinct within a batch
        total[np.searchsorted(one, k)] += _unpack(c, len(k)).astype(np.int64)
    return [_pack(total[np.searchsorted(one, k)]) for k in keys], total


def _count(batches):
    """Rows (batch, bucket, totals of words, of bigrams) back to the batches; batch -1 holds (types, tokens)."""
    for group in runs(batches, ["bucket"]):
        bucket = group.column("bucket")[0].as_py()
        t1, all1 = _totals([np.frombuffer(x, np.uint64) for x in group.column("h1").to_pylist()], group.column("n1").to_pylist())
        t2, _ = _totals([_from48(x) for x in group.column("h2").to_pylist()], group.column("n2").to_pylist())
        n = len(t1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*group.column("batch").to_pylist(), -1], pa.int32()), pa.array([bucket] * (n + 1), pa.int32()),
             pa.array([*t1, None], pa.binary()), pa.array([*t2, None], pa.binary()),
             pa.array([0] * n + [int((all1 > 0).sum())], pa.int64()), pa.array([0] * n + [int(all1.sum())], pa.int64())],
            names=["batch", "bucket", "t1", "t2", "types", "tokens"])


_COUNTED = "doc_id long, train boolean, n int, c1 binary, c2 binary, types long, tokens long"


def _join(buckets: int):
    """Per document the counts of its tokens (c1) and bigrams (c2); a bucket's sizes as rows of their own."""

    def work(texts: pa.Table, totals: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            k = totals.num_rows
            none = pa.nulls(k, pa.binary())
            return pa.Table.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.int32()), none, none,
                 totals.column("types"), totals.column("tokens")],
                names=["doc_id", "train", "n", "c1", "c2", "types", "tokens"])
        flat, before, first = _tokens(texts.column("text"), WordHasher(lower=True))

        def counted(keys: np.ndarray, column: str) -> np.ndarray:
            one, at = np.unique(keys, return_inverse=True)
            bound, out = _bounds(one, buckets), np.zeros(len(one), np.int64)
            for b, x in zip(totals.column("bucket").to_pylist(), totals.column(column).to_pylist()):
                out[bound[b] : bound[b + 1]] = _unpack(x, bound[b + 1] - bound[b])
            return out[at]

        # Words, then bigrams: only one kind of key is held at a time.
        c1 = counted(flat, "t1")
        pairs = _pairs(flat, before)
        del flat, before
        c2 = counted(pairs, "t2")
        spans = list(zip(first[:-1].tolist(), first[1:].tolist()))
        k = len(spans)
        return pa.Table.from_arrays(
            [texts.column("doc_id"), texts.column("train"), pa.array(np.diff(first).astype(np.int32)),
             pa.array([_pack(c1[a:b]) for a, b in spans], pa.binary()), pa.array([_pack(c2[a:b]) for a, b in spans], pa.binary()),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())],
            names=["doc_id", "train", "n", "c1", "c2", "types", "tokens"])

    return work


def token_counts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Corpus counts of every token and bigram of every document, written to the shared folder."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), train.alias("train"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    cuts, buckets = max(1, -(-int(size) // BATCH_BYTES)), max(1, -(-int(size) // BUCKET_BYTES))
    texts = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(cuts)).cast("int")).repartition(parts, "batch")
    sent = texts.sortWithinPartitions("batch").mapInArrow(
        _send(buckets), "bucket int, batch int, h1 binary, n1 binary, h2 binary, n2 binary")
    totals = sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "batch").mapInArrow(
        _count, "batch int, bucket int, t1 binary, t2 binary, types long, tokens long")
    return scratch(texts.groupBy("batch").cogroup(totals.groupBy("batch")).applyInArrow(_join(buckets), _COUNTED))


def _context(ch: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for none, else one per power of two."""
    out = np.zeros(len(ch), np.int64)
    some = ch > 0
    out[some] = 1 + np.floor(np.log2(ch[some])).astype(np.int64)
    return out


def _counts(batch, r: int, begins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bigram, context, token) counts of a document's tokens as doubles."""
    n = batch.column("n")[r].as_py()
    c1 = _unpack(batch.column("c1")[r].as_py(), n).astype(np.float64)
    c2 = _unpack(batch.column("c2")[r].as_py(), n).astype(np.float64)
    ch = np.empty(n)
    ch[0], ch[1:] = begins, c1[:-1]
    return c2, ch, c1


def _held_out(tokens: int, types: int, begins: int):
    """Rows (context, q2, q1, n): training tokens, each left out of its counts, by binned estimate ratios."""

    def work(batches):
        seen: dict = {}
        uniform = 1 / (types + 1)
        for batch in batches:
            parts = [_counts(batch, r, begins) for r in range(batch.num_rows)]
            if not parts:
                continue
            c2, ch, c1 = (np.concatenate(x) - 1 for x in zip(*parts))
            with np.errstate(divide="ignore", invalid="ignore"):
                q2 = np.where(c2 > 0, np.rint(np.log(c2 / ch / uniform) / GRID), -10_000)
                q1 = np.where(c1 > 0, np.rint(np.log(c1 / max(tokens - 1, 1) / uniform) / GRID), -10_000)
            # One integer per cell; ratios lie within a few hundred bins of zero.
            cell = (_context(ch) << 40) + ((q2.astype(np.int64) + 10_000) << 20) + q1.astype(np.int64) + 10_000
            rows, times = np.unique(cell, return_counts=True)
            for c, k in zip(rows.tolist(), times.tolist()):
                key = (c >> 40, (c >> 20 & 0xFFFFF) - 10_000, (c & 0xFFFFF) - 10_000)
                seen[key] = seen.get(key, 0) + k
        cols = list(zip(*(k + (v,) for k, v in seen.items()))) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["context", "q2", "q1", "n"])

    return work


def mixture(rows) -> dict[int, tuple[float, float, float]]:
    """Weights (bigram, unigram, uniform) per context bucket by expectation-maximisation."""
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["context"], []).append((r["q2"], r["q1"], r["n"]))
    out = {}
    for context, cells in by.items():
        q2, q1, n = np.array(cells, float).T
        p = np.stack([np.where(q2 > -10_000, np.exp(q2 * GRID), 0), np.where(q1 > -10_000, np.exp(q1 * GRID), 0), np.ones(len(n))])
        w = np.full(3, 1 / 3)
        for _ in range(EM_STEPS):
            share = w[:, None] * p
            share /= share.sum(axis=0)
            w = (share * n).sum(axis=1) / n.sum()
        w = np.maximum(w, [0, 1e-6, 1e-6])  # no text gets probability zero
        out[int(context)] = tuple((w / w.sum()).tolist())
    return out


def _score(weights: dict, tokens: int, types: int, begins: int):
    top = max(weights, default=0)
    table = np.zeros((top + 1, 3))
    table[:] = (0.0, 0.5, 0.5) if weights else (0.0, 0.0, 1.0)
    for k in range(top + 1):
        table[k] = weights.get(k, table[k - 1] if k else table[0])

    def work(batches):
        for batch in batches:
            known, base, score = [], [], []
            for r in range(batch.num_rows):
                c2, ch, c1 = _counts(batch, r, begins)
                w = table[np.minimum(_context(ch), top)]
                with np.errstate(divide="ignore", invalid="ignore"):
                    p2 = np.where(ch > 0, c2 / ch, 0)
                p = w[:, 0] * p2 + w[:, 1] * (c1 / max(tokens, 1)) + w[:, 2] / (types + 1)
                known.append(int((c1 > 0).sum()))
                base.append(float(np.log10((c1 + 1) / (tokens + types + 1)).sum()))
                score.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("train"), batch.column("n").cast(pa.int64()), pa.array(known, pa.int64()),
                 pa.array([tokens] * len(known), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return work


def scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) per row; log10 probabilities."""
    counted = token_counts(docs, train, id_col, text_col)
    sizes = counted.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"),
                        F.count(F.when(F.col("train"), 1)).alias("begins")).first()
    types, tokens, begins = int(sizes.types or 0), int(sizes.tokens or 0), int(sizes.begins)
    texts = counted.where("n is not null").select("doc_id", "train", "n", "c1", "c2")
    # At most (contexts) x (ratio bins) ** 2 rows, whatever the size of the corpus.
    held = texts.where("train").mapInArrow(_held_out(tokens, types, begins), "context long, q2 long, q1 long, n long").groupBy(
        "context", "q2", "q1").agg(F.sum("n").alias("n")).collect()
    return texts.mapInArrow(_score(mixture(held), tokens, types, begins),
                            "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
