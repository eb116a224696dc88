"""MinHash near-duplicate groups: many universal hash minima, banding, signature and exact checks.

1. Every text becomes its set of distinct word shingles (64-bit hashes); ``HASHES`` universal hash
   functions give its signature of minima. Equal sets are one class, so copies cost one class.
2. ``BANDS`` bands of the signature are bucket keys. At similarity 0.75 four rows a band and 32 bands
   miss a pair with probability (1 - 0.75**4)**32 = 5e-6.
3. In each bucket every class is paired with the bucket's least class. The pairs pass a size test, a
   signature test (estimate at least ``MIN_ESTIMATE``: a pair at 0.75 falls below it with probability
   3e-10), then the exact test on full sets. Components by alternating large-star and small-star.
4. Buckets that still hold more than one component are compared across components: pairs of blocks of
   members are dealt to tasks, which compare signatures as arrays, then full sets. A pair is tested in its
   first common band only, and not once its ends are joined; only links that join components leave the
   task, so no list of pairs is ever made.

Defined cases: a null text is empty; an empty text has no shingle and is linked with nothing; rows
that repeat a doc_id are one node; rows with a null doc_id are linked with nothing and kept; columns
other than the id and the text are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WordHasher, doc_slices, runs, scratch, shingle_sets, string_buffer
from playlens.llm.components import components

SHINGLE = 5
HASHES = 128
BANDS = 32
MIN_ESTIMATE = 0.50
BLOCK = 2048  # members of a block, fewer if their sets pass BLOCK_SHINGLES
BLOCK_SHINGLES = 4_000_000


def _sets(batch: pa.RecordBatch, hasher: WordHasher, shingle: int):
    """Per row of ``batch`` (column ``text``) its sorted distinct shingle hashes."""
    data, offsets = string_buffer(batch.column("text"))
    for i, j in doc_slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = hasher.split(part, offsets[i : j + 1] - offsets[i])
        yield from shingle_sets(hasher.hashes(part, starts, ends), first, shingle)


def _signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of ``(a * x + b) mod 2**64 >> 32`` per set; the sets are not empty."""
    out = np.empty((len(sets), len(a)), np.uint32)
    i = 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= 32768):
            total += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        at = np.cumsum([0] + [len(s) for s in sets[i : j - 1]])
        work = np.empty_like(flat)
        for k in range(len(a)):
            np.multiply(flat, a[k], out=work)
            np.add(work, b[k], out=work)
            out[i:j, k] = np.minimum.reduceat(work, at) >> np.uint64(32)
        i = j
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               hashes: int = HASHES, bands: int = BANDS, seed: int = 7) -> DataFrame:
    """(doc_id, n, cls, sig, bands): set size, hash of the set, minima, and band keys (null if empty)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**64, hashes, dtype=np.uint64)
    rows = hashes // bands

    def work(batches):
        hasher = WordHasher(lower=True)
        for batch in batches:
            sets = list(_sets(batch, hasher, shingle))
            full = [i for i, s in enumerate(sets) if len(s)]
            sigs = _signatures([sets[i] for i in full], a, b)
            sig, keys, cls = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for r, i in enumerate(full):
                sig[i] = sigs[r].tobytes()
                cls[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                keys[i] = [
                    int.from_bytes(hashlib.blake2b(sig[i][k * rows * 4 : (k + 1) * rows * 4], digest_size=8,
                                                   salt=k.to_bytes(4, "big")).digest(), "big", signed=True)
                    for k in range(bands)
                ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n", "cls", "sig", "bands"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        work, "doc_id long, n long, cls binary, sig binary, bands array<long>")


def _size_ok(n: str, m: str):
    return 100 * F.least(n, m) >= 75 * F.greatest(n, m)


def _linked(p: np.ndarray, q: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets reach ``threshold`` percent Jaccard."""
    both = np.concatenate([p, q])
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= threshold * (len(p) + len(q) - inter)


def _similar(threshold: int):
    """Keeps pairs (a, b, x, y) whose sets x, y reach ``threshold`` percent Jaccard."""

    def work(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                keep.append(_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return work


def _estimate(batches):
    """Keeps pairs (a, b, x, y) of signatures that agree in at least MIN_ESTIMATE of the minima."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
        y = np.frombuffer(b"".join(batch.column("y").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
        keep = (x == y).mean(axis=1) >= MIN_ESTIMATE
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _with_payload(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """Adds x and y, the payload of a and b (``side``: rep, payload)."""
    x = side.select(F.col("rep").alias("a"), F.col("payload").alias("x"))
    y = side.select(F.col("rep").alias("b"), F.col("payload").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")


def _cross_component(threshold: int, bands: int):
    """Links between members of a block pair that join two components; see the module's step 4."""

    def work(batches):
        for group in runs(batches, ["key", "lo", "hi"]):
            rep, root, blk, n = (group.column(c).to_numpy() for c in ("rep", "root", "blk", "n"))
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(len(rep), -1)
            sets = group.column("payload")
            band, lo, hi = (group.column(c)[0].as_py() for c in ("band", "lo", "hi"))
            up = {r: r for r in set(root.tolist())}

            def top(r):
                while up[r] != r:
                    up[r] = up[up[r]]
                    r = up[r]
                return r

            left, right = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
            out_a, out_b = [], []
            for i in left.tolist():
                js = right[right > i] if lo == hi else right
                js = js[(root[js] != root[i]) & (100 * np.minimum(n[js], n[i]) >= threshold * np.maximum(n[js], n[i]))]
                same = sig[js] == sig[i]
                first = same.reshape(len(js), bands, sig.shape[1] // bands).all(axis=2).argmax(axis=1)
                js = js[(same.mean(axis=1) >= MIN_ESTIMATE) & (first == band)]
                x = np.frombuffer(sets[i].as_py(), np.uint64) if len(js) else None
                for j in js.tolist():
                    r, q = top(root[i]), top(root[j])
                    if r != q and _linked(x, np.frombuffer(sets[j].as_py(), np.uint64), threshold):
                        up[max(r, q)] = min(r, q)
                        out_a.append(min(rep[i], rep[j]))
                        out_b.append(max(rep[i], rep[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return work


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 75,
                    shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; links at ``threshold`` percent or more."""
    sig = scratch(signatures(docs, id_col, text_col, shingle))
    known = sig.where("n > 0 and doc_id is not null")
    classes = scratch(known.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                               F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    banded = classes.select("rep", "n", F.posexplode("bands").alias("band", "hash")).select(
        "rep", "n", "band", F.xxhash64("band", "hash").alias("key"))
    heads = banded.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("head"), F.count("*").alias("size")).where("size > 1")
    members = banded.join(heads, "key").select("key", "band", "rep", "n", "size", F.col("head.rep").alias("a"), F.col("head.n").alias("an"))
    members = scratch(members)
    minima = classes.select("rep", F.col("sig").alias("payload"))
    star = members.where(F.col("rep") != F.col("a")).where(_size_ok("n", "an")).select("a", F.col("rep").alias("b")).distinct()
    star = scratch(_with_payload(star, minima).mapInArrow(_estimate, "a long, b long"))

    # Full sets of every class that shares a bucket with another: one pass over the texts.
    def full_sets(batches):
        hasher = WordHasher(lower=True)
        for batch in batches:
            sets = [s.tobytes() for s in _sets(batch, hasher, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, pa.binary())], names=["rep", "payload"])

    shared = members.select("rep").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    sets = scratch(texts.join(shared, "rep").mapInArrow(full_sets, "rep long, payload binary"))

    edges = scratch(_with_payload(star, sets).mapInArrow(_similar(threshold), "a long, b long").distinct())
    roots = components(edges)
    placed = members.where("size > 2").select("key", "band", "rep", "n").join(
        roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size"),
                                      F.sum("n").alias("shingles")).where("x <> y")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = placed.join(mixed.select("key", blocks.alias("nb")), "key").withColumn("blk", F.pmod(F.xxhash64("rep"), "nb").cast("int"))
    placed = placed.join(minima.withColumnRenamed("payload", "sig"), "rep").join(sets, "rep")
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "key", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "band", "rep", "root", "n", "sig", "payload")
    late = scratch(dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep").mapInArrow(
        _cross_component(threshold, BANDS), "a long, b long").distinct())
    if late.limit(1).count():
        roots = components(edges.unionByName(late))

    owner = classes.select("cls", "rep").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "cls", F.coalesce("root", "rep").alias("root"))
    full = known.select("doc_id", "n", "cls").join(owner, "cls").select("doc_id", "n", F.col("root").alias("component_id"))
    rest = sig.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose group has a smaller id; all columns stay as they are."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
