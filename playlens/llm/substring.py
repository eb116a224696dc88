"""Repeated-passage removal with difference-cover anchors.

A window is ``WINDOW`` consecutive words. The positions whose index modulo ``PERIOD`` lies in ``COVER``
are anchors; for any two positions some shift below ``PERIOD`` puts both on an anchor, so two equal
windows always hold an equal, aligned anchor run of ``WINDOW - PERIOD + 1`` words.

1. Anchor runs are hashed; a run is shared if different rows hold it.
2. Shared anchors are sent back to their rows. Every window that could hold one is hashed whole
   (the extension); all others are unique and never leave the task.
3. Windows that a document with a smaller id also has are cut.
Exact copies of a text are recognised first: all but the least id are cut whole and emit no window.

Anchors, windows and texts are shuffled once each. A task settles what its own batch can show: of anchors that
several rows of a batch share, and of windows that a smaller id of the batch has, one is sent by its hash to
meet other batches, and the rest are known already and go by row key. A passage in a third of all
documents so costs its hash a row per batch. What is sent by hash is read in sorted order as a stream.

Window hashes have 96 bits over 64-bit word hashes: among 10^12 windows a false match is expected 10^-5 times.
A row key has 64 bits; rows whose keys clash are told apart by id, and share their marks, which only say
where to look.

Defined cases: a null text has no words; documents under ``WINDOW`` words lose nothing; rows with a null
id lose nothing and count for no one; rows that repeat an id do not cut each other (a smaller id is
needed); other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WordHasher, doc_slices, mix, shuffle_partitions, string_buffer, window_hashes

WINDOW = 50
# A perfect difference set modulo 31.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


def _words(batch: pa.RecordBatch, hasher: WordHasher):
    """(row, word hashes) of every row with at least one window."""
    data, offsets = string_buffer(batch.column("text"))
    for i, j in doc_slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = hasher.split(part, offsets[i : j + 1] - offsets[i])
        yield i, first, hasher.hashes(part, starts, ends)


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by the columns, where each group of equal rows starts in it)."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(new)


def _anchors(window: int):
    """Rows (h, key, pos) of every anchor. A batch's known shared ones: the first with pos as ~pos, others without h."""
    run = window - PERIOD + 1

    def work(batches):
        hasher = WordHasher()
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        for batch in batches:
            owner = batch.column("key").to_numpy(zero_copy_only=False)
            hs, keys, places = [], [], []
            for i, first, words in _words(batch, hasher):
                count = np.diff(first)
                if not (count >= window).any():
                    continue
                hashes = window_hashes(words, run)
                doc = np.repeat(np.arange(len(count)), count)[: len(hashes)]
                pos = np.arange(len(hashes)) - first[doc]
                keep = cover[pos % PERIOD] & (pos + run <= count[doc]) & (count[doc] >= window)
                hs.append(hashes[keep])
                keys.append(owner[i + doc[keep]])
                places.append(pos[keep].astype(np.int32))
            if not hs:
                continue
            h, key, pos = np.concatenate(hs), np.concatenate(keys), np.concatenate(places)
            if len(h) == 0:
                continue
            order, starts = _groups(h)
            h, key, pos = h[order], key[order], pos[order]
            shared = np.minimum.reduceat(key, starts) < np.maximum.reduceat(key, starts)
            away = np.repeat(shared, np.diff(np.append(starts, len(h))))
            away[starts] = False
            first = starts[shared]
            pos[first] = ~pos[first]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), mask=away), pa.array(key), pa.array(pos)], names=["h", "key", "pos"])

    return work


def _shared(batches):
    """Rows (key, pos) of the shared anchors, from (h, key, pos) sorted by h: a run is held until it ends."""

    def told(h, key, pos):
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        known = pos < 0
        both = (np.minimum.reduceat(key, starts) < np.maximum.reduceat(key, starts)) | np.logical_or.reduceat(known, starts)
        keep = np.repeat(both, np.diff(np.append(starts, len(h))))
        return key[keep], np.where(known, ~pos, pos)[keep]

    def rows(key, pos):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(pos.astype(np.int32))], names=["key", "pos"])

    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    for batch in batches:
        none = np.asarray(batch.column("h").is_null())
        h, key, pos = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False) for c in ("h", "key", "pos"))
        if none.any():
            yield rows(key[none], pos[none])
        whole = [np.concatenate([x, y[~none]]) for x, y in zip(held, (h, key, pos))]
        if len(whole[0]) == 0:
            continue
        cut = int(np.searchsorted(whole[0], whole[0][-1], "left"))
        held = [x[cut:] for x in whole]
        if cut:
            yield rows(*told(*(x[:cut] for x in whole)))
    if len(held[0]):
        yield rows(*told(*held))


def _windows(window: int):
    """Rows (w, v, doc_id, key, start) of every window that may hold a shared anchor; no w where the batch has a smaller id."""

    def work(batches):
        hasher = WordHasher()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            marks = batch.column("marks")
            found = []
            for i, first, words in _words(batch, hasher):
                out_w, out_v, out_s, out_r = [], [], [], []
                for r in range(len(first) - 1):
                    n = int(first[r + 1] - first[r])
                    at = np.unique(marks[i + r].values.to_numpy())
                    if n < window or at[0] < 0:
                        continue
                    at = at[at < n]
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.maximum(at - PERIOD + 1, 0), 1)
                    np.add.at(edge, at + 1, -1)
                    starts = np.flatnonzero(np.cumsum(edge)[: n - window + 1] > 0)
                    own = words[first[r] : first[r + 1]]
                    out_w.append(window_hashes(own, window)[starts])
                    out_v.append((window_hashes(mix(own), window)[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    out_s.append(starts.astype(np.int32))
                    out_r.append(np.full(len(starts), i + r))
                if out_w:
                    rows = np.concatenate(out_r)
                    found.append((np.concatenate(out_w), np.concatenate(out_v), ids[rows], keys[rows], np.concatenate(out_s)))
            if not found:
                continue
            w, v, doc, key, start = (np.concatenate(x) for x in zip(*found))
            if len(w) == 0:
                continue
            order, starts = _groups(w, v)
            w, v, doc, key, start = (x[order] for x in (w, v, doc, key, start))
            least = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(w))))
            later = doc > least
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.view(np.int64), mask=later), pa.array(v, mask=later), pa.array(doc), pa.array(key), pa.array(start)],
                names=["w", "v", "doc_id", "key", "start"])

    return work


def _later(batches):
    """Rows (key, doc_id, pos) of the windows to cut, from rows sorted by (w, v, doc_id): a run's first id is the least."""
    last = None
    for batch in batches:
        none = np.asarray(batch.column("w").is_null())
        w, v, doc, key, start = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False) for c in ("w", "v", "doc_id", "key", "start"))
        cut = none.copy()
        at = np.flatnonzero(~none)
        if len(at):
            new = np.concatenate([[True], (w[at][1:] != w[at][:-1]) | (v[at][1:] != v[at][:-1])])
            starts = np.flatnonzero(new)
            least = doc[at][starts]
            if last is not None and (w[at[0]], v[at[0]]) == last[:2]:
                least[0] = last[2]
            last = (w[at[-1]], v[at[-1]], least[-1])
            cut[at] = doc[at] > np.repeat(least, np.diff(np.append(starts, len(at))))
        if cut.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[cut]), pa.array(doc[cut]), pa.array(start[cut])], names=["key", "doc_id", "pos"])


def _cut(window: int, with_text: bool):
    """Counts, digest and, if asked for, the text without the cut words (its other white space stays)."""

    def work(batches):
        hasher = WordHasher()
        for batch in batches:
            data, offsets = string_buffer(batch.column("text"))
            cuts = batch.column("cuts")
            absent = np.asarray(cuts.is_null())
            empty = np.asarray(batch.column("text").is_null())
            total, removed, digest, texts = [], [], [], []
            for r in range(batch.num_rows):
                raw = data[offsets[r] : offsets[r + 1]]
                body = raw.tobytes()
                words = body.split()
                n = len(words)
                gone = None
                if not absent[r] and n >= window:
                    at = cuts[r].values.to_numpy()
                    if at.min() < 0:
                        gone = np.ones(n, bool)
                    else:
                        edge = np.zeros(n + 1, np.int64)
                        edge[at] += 1
                        edge[at + window] -= 1
                        gone = np.cumsum(edge[:n]) > 0
                total.append(n)
                removed.append(0 if gone is None else int(gone.sum()))
                kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                if with_text:
                    if gone is not None:
                        starts, _, _ = hasher.split(raw, np.array([0, len(raw)]))
                        bounds = np.append(starts, len(raw))
                        stay = np.ones(len(raw), bool)
                        for k in np.flatnonzero(gone):
                            stay[bounds[k] : bounds[k + 1]] = False
                        body = raw[stay].tobytes().rstrip(b" \t\n\r\x0b\x0c")
                    texts.append(None if empty[r] else body.decode())
            cols = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols += [batch.column("row"), pa.array(texts, pa.string())]
                names += ["row", "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return work


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                      carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of ``docs``.

    With ``carry`` (columns of ``docs``) also ``row``, a struct of them, and ``kept_text``: the text
    without the words that a window of a smaller document covers.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    key = F.xxhash64(doc_id, text)
    row = [F.struct(*[docs[c] for c in carry]).alias("row")] if carry is not None else []
    base = docs.select(doc_id.alias("doc_id"), key.alias("key"), text.alias("text"), *row)
    known = base.where("doc_id is not null and text is not null")

    digests = known.select("key", "doc_id", F.md5("text").alias("same"))
    least = digests.groupBy("same").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("x")).where("m < x")
    copies = digests.join(least, "same").where("doc_id > m").select("key", "doc_id", F.lit(-1).alias("pos"))

    parts = shuffle_partitions(docs.sparkSession)
    anchors = known.select("key", "text").mapInArrow(_anchors(window), "h long, key long, pos int")
    shared = anchors.repartition(parts, F.coalesce("h", "key")).sortWithinPartitions("h").mapInArrow(_shared, "key long, pos int")
    marks = shared.unionByName(copies.select("key", "pos")).groupBy("key").agg(F.collect_list("pos").alias("marks"))

    # Sorted, so that a task that runs again makes the same batches and sends the same rows.
    # All columns of all rows, as in the last join: both read one exchange of the texts. Rows without an id have no marks.
    marked = base.join(marks, "key").select(*base.columns, "marks").sortWithinPartitions("key", "doc_id")
    windows = marked.mapInArrow(_windows(window), "w long, v int, doc_id long, key long, start int")
    dealt = windows.repartition(parts, F.coalesce("w", "key")).sortWithinPartitions("w", "v", "doc_id")
    found = dealt.mapInArrow(_later, "key long, doc_id long, pos int")
    cuts = found.unionByName(copies).groupBy("key", "doc_id").agg(F.collect_set("pos").alias("cuts")).select(
        "key", F.col("doc_id").alias("of"), "cuts")

    # The ids are not compared as equal columns: the texts are dealt by key, and that exchange is to serve here too.
    joined = base.join(cuts, (base["key"] == cuts["key"]) & (F.col("doc_id") - F.col("of") == 0), "left").select(
        "doc_id", base["key"], "text", *(["row"] if carry is not None else []), "cuts")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if carry is not None:
        schema += f", row {joined.schema['row'].dataType.simpleString()}, kept_text string"
    return joined.mapInArrow(_cut(window, carry is not None), schema)
