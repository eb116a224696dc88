"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenised, cut into pieces of at most ``capacity`` tokens and dealt to shards of about
``SHARD`` pieces by a hash. Every shard is solved by ``ISLANDS`` islands, each a task of its own with its
own population: crossover injects whole well-filled bins of one parent into the other, bins that now
repeat a piece are removed, and their displaced pieces are re-inserted best-fit, longest first. After
each epoch an island takes in the elite of its neighbour. The best island's bins are kept if they are
nearly full; the pieces of the others are pooled into fewer shards and solved again, until one shard is
left. All state is one row per shard and island, so no task holds more than a shard.

Defined cases: a null text is empty and gives one piece, the end token; repeated rows give their own
pieces; a null id is packed like any other; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import doc_slices, scratch, string_buffer
from playlens.llm.tokens import byte_class

CAPACITY = 1024
END_ID = 2
SHARD = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
WELL_FILLED = 0.99

# A break before a blank or newline that follows other text is always a token boundary, and so is one before a mark
# that follows a letter; texts with other white space are encoded whole.
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANKS = (" ", "\n")
_IS_BLANK = byte_class((0x20, 0x20), (0x0A, 0x0A))
_IS_MARK = byte_class(*((ord(c), ord(c)) for c in '.,!?;:&$*%)"]}'))
_IS_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_CACHE_ENTRIES = 400_000
_CACHE_CHARS = 32 << 20
_JOINED = 2000
_SLICE = 8 << 20


def _chunks(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Chunks of the texts between ``offsets``, and per text the index of its first one; ``whole`` texts are one chunk."""
    blank = _IS_BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = blank[1:] & ~blank[:-1] | _IS_MARK[data[1:]] & _IS_LETTER[data[:-1]]
    for i in whole:
        cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    chunks = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
    return chunks, np.searchsorted(bounds, offsets)


class _Chunks:
    """Ids of chunks seen before: a chunk has a slot, and a slot a run of ``ids``."""

    def __init__(self, tokenizer):
        self.tokenizer, self.widths = tokenizer, _token_widths(tokenizer)
        self._clear()

    def _clear(self) -> None:
        self.slot, self.chars = {}, 0
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def _joined_ids(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of chunks that start with a blank and end without one: they are encoded as one text, which
        spares a call each, and cut where their bytes end (``sizes``: bytes of each chunk)."""
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        ends, cuts = np.cumsum(self.widths[ids]), np.cumsum(sizes)
        at = np.searchsorted(ends, cuts)
        if not np.array_equal(ends[at], cuts):
            raise ValueError("a token spans two chunks")
        return ids, np.diff(at, prepend=-1)

    def _add(self, chunks: list[str], sizes: np.ndarray, whole: set[str]) -> np.ndarray:
        """Slots of new chunks."""
        join = np.array([c[0] in _BLANKS and c[-1] not in _BLANKS and c not in whole for c in chunks], bool)
        found, counts = [self.ids], []
        joined, sizes = [c for c, j in zip(chunks, join.tolist()) if j], sizes[join]
        for at in range(0, len(joined), _JOINED):
            ids, n = self._joined_ids(joined[at : at + _JOINED], sizes[at : at + _JOINED])
            found.append(ids)
            counts.append(n)
        alone = [c for c, j in zip(chunks, join.tolist()) if not j]
        for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False):
            found.append(np.array(e.ids, "<u4"))
            counts.append([len(e.ids)])
        slots = np.empty(len(chunks), np.int64)
        slots[np.argsort(~join, kind="stable")] = np.arange(len(self.slot), len(self.slot) + len(chunks))
        self.slot.update(zip(chunks, slots.tolist()))
        self.chars += sum(map(len, chunks))
        self.ids = np.concatenate(found)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))])
        return slots

    def encoded(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts, and per text where its ids start; at last the number of ids."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        rare = {i: t for i, t in enumerate(texts.to_pylist()) if t and _RARE_SPACE.search(t)}
        chunks, first = _chunks(data, offsets, np.array(list(rare), np.int64))
        coded = chunks.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slot) > _CACHE_ENTRIES or self.chars > _CACHE_CHARS:
            self._clear()
        known = self.slot
        slots = np.array([known.get(c, -1) for c in own], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            sizes = np.diff(np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(own) + 1])
            slots[new] = self._add([own[i] for i in new.tolist()], sizes[new], set(rare.values()))
        slots = slots[np.asarray(coded.indices)]
        start = self.first[slots]
        count = self.first[slots + 1] - start
        bounds = np.concatenate([[0], np.cumsum(count)])
        places = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], count)
        return self.ids[places], bounds[first]


def _token_widths(tokenizer) -> np.ndarray:
    """Bytes of each token: a byte-level vocabulary spells a byte as one character."""
    vocab = tokenizer.get_vocab()
    widths = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        widths[i] = len(token)
    return widths


@lru_cache(maxsize=1)
def _chunk_ids(tokenizer_path: str) -> _Chunks:
    """One a worker process, for all of its tasks."""
    from tokenizers import Tokenizer

    return _Chunks(Tokenizer.from_file(tokenizer_path))


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids binary]) of every document, tokenised whole.

    The first piece of a document is the shorter one; ``ids`` are little-endian uint32.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        chunks = _chunk_ids(tokenizer_path)
        for batch in batches:
            data, offsets = string_buffer(batch.column("text"))
            for a, b in doc_slices(offsets, _SLICE):
                part = batch.slice(a, b - a)
                found, first = chunks.encoded(part.column("text"), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cols: list[list] = [[], [], [], [], [], []]
                for doc, x, y in zip(part.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                    ids = found[x:y].tobytes() + end
                    n, start, k = len(ids) // 4, 0, 0
                    while start < n:
                        size = (n % capacity or capacity) if start == 0 else capacity
                        own = ids[4 * start : 4 * (start + size)]
                        for c, v in zip(cols, (doc, k, start, size, zlib.crc32(own), own)):
                            c.append(v)
                        start, k = start + size, k + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                keep = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:keep], kinds)], names=names[:keep])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


class _Bins:
    """Bins under construction, with the free space of open bins in one bit set for best-fit."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free = capacity, [], []
        self.at, self.mask = [[] for _ in range(capacity + 1)], 0

    def add(self, items: list, fill: int) -> None:
        free = self.capacity - fill
        if free:
            self.at[free].append(len(self.bins))
            self.mask |= 1 << free
        self.bins.append(items)
        self.free.append(free)

    def place(self, item: int, size: int) -> None:
        room = self.mask >> size
        if not room:
            self.add([item], size)
            return
        free = size + (room & -room).bit_length() - 1
        b = self.at[free].pop()
        if not self.at[free]:
            self.mask ^= 1 << free
        self.bins[b].append(item)
        left = self.free[b] = free - size
        if left:
            self.at[left].append(b)
            self.mask |= 1 << left


def _fitness(bins: list, sizes: list) -> tuple:
    return len(bins), -sum(sum(map(sizes.__getitem__, b)) ** 2 for b in bins)


def _fresh(sizes: list, capacity: int, rng: random.Random, noise: float) -> list:
    out = _Bins(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + noise * rng.random())):
        out.place(i, sizes[i])
    return out.bins


def _cross(a: list, b: list, sizes: list, capacity: int, rng: random.Random) -> list:
    """Whole well-filled bins of ``b`` go into ``a``; what they displace is re-inserted best-fit."""
    good = [g for g in b if sum(map(sizes.__getitem__, g)) >= WELL_FILLED * capacity]
    rng.shuffle(good)
    inject = good[: max(1, len(good) // 3)]
    taken = {i for g in inject for i in g}
    out, loose = _Bins(capacity), []
    for g in inject:
        out.add(list(g), sum(map(sizes.__getitem__, g)))
    for g in a:
        fill = sum(map(sizes.__getitem__, g))
        # Poorly filled bins are opened too, so that their pieces can move.
        if taken.isdisjoint(g) and (fill >= WELL_FILLED * capacity or rng.random() < 0.5):
            out.add(list(g), fill)
        else:
            loose += [i for i in g if i not in taken]
    for i in sorted(loose, key=lambda i: -sizes[i]):
        out.place(i, sizes[i])
    return out.bins


def evolve(sizes: list, capacity: int, seed: int, elites: list) -> list:
    """The best bins (lists of indices) after GENERATIONS from ``elites`` and fresh best-fit solutions."""
    rng = random.Random(seed)
    pool = [*elites]
    while len(pool) < POPULATION:
        pool.append(_fresh(sizes, capacity, rng, 0.0 if not pool else 0.15))
    ranked = sorted(((_fitness(p, sizes), k, p) for k, p in enumerate(pool)))
    bound = -(-sum(sizes) // capacity)
    for g in range(GENERATIONS):
        if ranked[0][0][0] <= bound:
            break
        children = []
        for k in range(POPULATION // 2):
            x, y = rng.sample(range(len(ranked)), 2) if len(ranked) > 1 else (0, 0)
            child = _cross(ranked[min(x, y)][2], ranked[max(x, y)][2], sizes, capacity, rng)
            children.append((_fitness(child, sizes), POPULATION * (g + 1) + k, child))
        ranked = sorted(ranked + children)[:POPULATION]
    return ranked[0][2]


def _as_bins(assigned: np.ndarray) -> list:
    order = np.argsort(assigned, kind="stable")
    cuts = np.flatnonzero(np.diff(assigned[order])) + 1
    return [g.tolist() for g in np.split(order, cuts)] if len(order) else []


def _epoch(capacity: int, epoch: int):
    def work(batches):
        for batch in batches:
            best, score = [], []
            for shard, island, sizes, own, migrant in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "island", "sizes", "own", "migrant"))):
                lengths = np.frombuffer(sizes, np.int32).tolist()
                elites = [_as_bins(np.frombuffer(e, np.int32)) for e in (own, migrant) if e is not None]
                bins = evolve(lengths, capacity, hash((shard, island, epoch)), elites)
                assigned = np.zeros(len(lengths), np.int32)
                for k, g in enumerate(bins):
                    assigned[g] = k
                best.append(assigned.tobytes())
                score.append(_fitness(bins, lengths))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("island"), batch.column("sizes"), pa.array(best, pa.binary()),
                 pa.array([s[0] for s in score], pa.int64()), pa.array([s[1] for s in score], pa.int64())],
                names=["shard", "island", "sizes", "own", "bins", "rest"])

    return work


_STATE = "shard long, island int, sizes binary, own binary, bins long, rest long"


def _packed(capacity: int, level: int, last: bool):
    """Rows per piece from (shard, items, own); pieces of poorly filled bins have no sequence yet."""

    def work(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                shard = batch.column("shard")[r].as_py()
                items = batch.column("items")[r].values
                assigned = np.frombuffer(batch.column("own")[r].as_py(), np.int32)
                cols = [items.field(k) for k in range(5)]
                sizes = np.asarray(cols[3])
                fill = np.bincount(assigned, sizes, minlength=1)
                order = np.argsort(assigned, kind="stable")
                run = np.cumsum(sizes[order]) - sizes[order]
                head = np.r_[True, assigned[order][1:] != assigned[order][:-1]]
                offset = np.empty(len(sizes), np.int64)
                offset[order] = run - np.maximum.accumulate(np.where(head, run, 0))
                done = np.ones(len(sizes), bool) if last else fill[assigned] >= WELL_FILLED * capacity
                seq = (level << 56) + (shard << 20) + assigned.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(seq, mask=~done), pa.array(offset)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return work


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _solve(items: DataFrame, shards: int, capacity: int, level: int, last: bool) -> DataFrame:
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    salt = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level))
    grouped = scratch(items.groupBy(F.pmod(salt, F.lit(shards)).alias("shard")).agg(
        F.sort_array(F.collect_list(F.struct(*names))).alias("items")))

    def lengths(batches):
        for batch in batches:
            sizes = [np.asarray(x.values.field(3)).astype(np.int32).tobytes() for x in batch.column("items")]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(sizes, pa.binary())], names=["shard", "sizes"])

    none = F.lit(None).cast("binary")
    state = grouped.mapInArrow(lengths, "shard long, sizes binary").select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "sizes", none.alias("own"), none.alias("migrant"))
    for epoch in range(EPOCHS):
        state = scratch(state.repartition("shard", "island").mapInArrow(_epoch(capacity, epoch), _STATE))
        migrants = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("own").alias("migrant"))
        if epoch < EPOCHS - 1:
            state = state.join(migrants, ["shard", "island"]).select("shard", "island", "sizes", "own", "migrant")
    best = state.groupBy("shard").agg(F.min(F.struct("bins", "rest", "island", "own")).alias("b")).select("shard", "b.own")
    return grouped.join(best, "shard").select("shard", "items", "own").mapInArrow(_packed(capacity, level, last), _PLACED)


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32)."""
    items = scratch(items)
    done, level, left = [], 0, items.count()
    while left:
        shards = -(-left // shard)
        placed = scratch(_solve(items, shards, capacity, level, shards == 1))
        done.append(placed.where("sequence_id is not null"))
        items = placed.where("sequence_id is null").drop("sequence_id", "offset")
        was, left, level = left, items.count(), level + 1
        if left and left >= 0.9 * was:  # nothing fits better: the rest is packed as it is
            done.append(_solve(items, -(-left // shard), capacity, level, True))
            break
    if not done:
        return items.withColumn("sequence_id", F.lit(None).cast("long")).withColumn("offset", F.lit(None).cast("long"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
