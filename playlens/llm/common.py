"""Helpers shared by the operators: word hashing over Arrow buffers, streamed groups, scratch tables.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. Those bytes never occur inside a
multi-byte UTF-8 sequence, so whole Arrow string buffers are split with array operations and no
Python string is made.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from playlens.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20  # documents are grouped to about this many bytes of text per array pass

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply); a bijection of uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def doc_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of at most ``limit`` bytes; a longer document is a range alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class WordHasher:
    """Splits UTF-8 buffers into words and gives each a 64-bit hash.

    The hash is a polynomial over a random value per byte, taken from prefix sums modulo 2**64, then
    mixed with the word's length. Work arrays cover at most one chunk, however long the text is.
    """

    def __init__(self, lower: bool = False, chunk: int = SLICE_BYTES):
        rng = np.random.default_rng(20240607)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.space = np.zeros(256, bool)
        self.space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        if lower:
            self.table[65:91] = self.table[97:123]
        self.chunk = chunk
        self._grow(chunk)

    def _grow(self, n: int) -> None:
        self.pow = np.cumprod(np.concatenate([[_U(1)], np.full(n, _MULT)]))
        self.inv = np.cumprod(np.concatenate([[_U(1)], np.full(n, _INV)]))

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): byte ranges of the words, and per document its first word's index."""
        n = len(data)
        if n == 0:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(len(offsets), np.int64)
        ink = ~self.space[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[0], before[1:] = False, ink[:-1]
        starts = np.flatnonzero(ink & (~before | edge[:-1]))
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, ink[1:]
        ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i, n = 0, len(starts)
        while i < n:
            lo = int(starts[i])
            j = max(int(np.searchsorted(ends, lo + self.chunk, "right")), i + 1)
            size = int(ends[j - 1]) - lo
            if size > len(self.pow) - 1:
                self._grow(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.table[data[lo : lo + size]] * self.pow[:size], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * self.inv[s] + (e - s).astype(np.uint64) * _MULT)
            i = j
        return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (the caller drops runs over two documents)."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    mult = _U(0xD6E8FEB86659FD93)
    n = len(words)
    power = np.cumprod(np.concatenate([[_U(1)], np.full(n, mult)]))
    inv = np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(pow(int(mult), -1, 1 << 64)))]))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inv[: n - size + 1] + _U(size))


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct shingle hashes.

    A document of fewer than ``size`` words has its whole sequence as one shingle; one without
    words has none.
    """
    full = window_hashes(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(full[a : b - size + 1])
        elif b > a:
            yield window_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal ``keys`` from batches sorted on them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        new = np.zeros(n, bool)
        for c in cols:
            if n > 1:
                same = pc.equal(c.slice(1), c.slice(0, n - 1))
                new[1:] |= ~np.asarray(pc.fill_null(same, False))
        here = tuple(c[0].as_py() for c in cols)
        if last is not None and here != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[n - 1].as_py() for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(df: DataFrame) -> DataFrame:
    """``df`` written to a new folder under the shared checkpoint folder and read back.

    Cuts the lineage like a checkpoint: the rows are computed once, survive lost executors, and can
    be read again with column pruning. The folder belongs to the cluster's scratch space.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
