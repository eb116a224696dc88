"""Ranked lexical search by dense blocked multiplication.

1. Items are dealt to groups by a hash, so that a group has about ``GROUP_TERMS`` terms at most (one item
   alone may have more). A group's compact vocabulary is sent to the tasks; its size is counted first, and
   a larger set of items makes more groups, each a pass of its own over the documents.
2. Every text is cut into terms in array operations; a row keeps its number of terms and the counts of those
   in the vocabulary. These postings are written once; N, L and the document frequencies are sums over them.
3. Weights of item terms are whole numbers, and so are the impacts of document terms. A tile of items (its
   own, smaller vocabulary) as a dense matrix times a tile of documents as a dense matrix gives all scores of
   the pair in float64. Each impact is under 10^6, so a product of the tile is exact as long as an item's
   weights in it sum to less than 2^53 / 10^6; a heavier tile is cut along its vocabulary and the exact parts
   are added in 64-bit integers.
4. Each task keeps per item its ``k`` best documents, by score, then least id: all that reach the k-th score
   of a tile are compared, so ties are never cut by chance. Two merges by item give the whole ranking.

Defined cases: a null text has no terms and is not counted in N; items without terms, or whose terms no
document holds, have no rows; documents under a null id come last among equal scores; rows that repeat
are documents (or items) of their own; texts are read whole; other columns are ignored; empty tables give
no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import doc_slices, scratch, string_buffer
from playlens.llm.tokens import byte_class, runs_of, strings

TOP = 10
SCALE = 1_000_000_000
K1, B_SHARE = 1000, 75
GROUP_TERMS = 200_000  # expected terms of a group of items
ITEM_TILE, TERM_TILE, DOC_TILE = 128, 1024, 1024
EXACT = 1 << 53
_MERGE = 64  # parts of the first merge

_TERM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all terms, lower-cased; index of each document's first)."""
    starts, ends, first = runs_of(_TERM[data], offsets)
    return strings(data, starts, ends), first


def item_terms(text: str | None) -> list[str]:
    data, offsets = string_buffer(pa.array([text], pa.string()))
    return terms_of(data, offsets)[0].to_pylist()


def postings(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts) per row: the number of terms, and those in ``vocabulary`` by their place."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def rows(data, offsets, known):
        tokens, first = terms_of(data, offsets)
        place = pc.fill_null(pc.index_in(tokens, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))[place >= 0]
        keys, counts = np.unique(doc * max(len(known), 1) + place[place >= 0], return_counts=True)
        doc, place = np.divmod(keys, max(len(known), 1))
        return np.diff(first), np.bincount(doc, minlength=len(offsets) - 1), place, counts

    def work(batches):
        known = pa.array(shared.value, pa.large_string())
        for batch in batches:
            data, offsets = string_buffer(batch.column("text"))
            parts = [rows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], known) for i, j in doc_slices(offsets)]
            if not parts:
                continue
            n, held, place, counts = (np.concatenate(x) for x in zip(*parts))
            ends = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(work, "doc_id long, n long, terms array<int>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def tiles(items: list[tuple[int, dict[int, int]]], exact: int = EXACT) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Tiles of (place, {term: weight}) items: (places, [(terms, items x terms matrix), ...]).

    Each matrix holds less than ``exact`` / 10^6 per item, so its product with impacts is exact.
    """
    out = []
    at = 0
    while at < len(items):
        vocabulary: set[int] = set()
        end = at
        while end < len(items) and end - at < ITEM_TILE and (end == at or len(vocabulary | items[end][1].keys()) <= TERM_TILE):
            vocabulary |= items[end][1].keys()
            end += 1
        parts, left = [], sorted(vocabulary)
        chosen, most = [], np.zeros(end - at, dtype=object)
        for t in left:
            own = np.array([items[i][1].get(t, 0) for i in range(at, end)], dtype=object)
            if chosen and (len(chosen) >= TERM_TILE or ((most + own) * (SCALE // K1) >= exact).any()):
                parts.append(chosen)
                chosen, most = [], np.zeros(end - at, dtype=object)
            chosen.append((t, own))
            most = most + own
        parts += [chosen] if chosen else []
        out.append((np.array([items[i][0] for i in range(at, end)], np.int64), [
            (np.array([t for t, _ in part], np.int64), np.array([w for _, w in part], np.float64).T.copy()) for part in parts]))
        at = end
    return out


def _best(score: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then least id; null ids last."""
    if len(score) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= bar)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], nulls[near], -score[near]))[:k]]


def scored(found: DataFrame, shared, n_docs: int, n_terms: int, size: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item."""

    def work(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                tile = batch.slice(at, DOC_TILE)
                terms = tile.column("terms")
                place = terms.flatten().to_numpy(zero_copy_only=False)
                counts = tile.column("counts").flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(tile.num_rows), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
                # Python integers: 75 * n * N may pass 64 bits before it is divided.
                m = np.array([100 - B_SHARE + B_SHARE * n * n_docs // max(n_terms, 1) for n in tile.column("n").to_pylist()], np.int64)
                impact = SCALE * counts // (K1 * counts + 8 * m[doc])
                ids = tile.column("doc_id")
                nulls = np.asarray(ids.is_null())
                ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
                for items, parts in shared.value:
                    total = np.zeros((len(items), tile.num_rows), np.int64)
                    for own, matrix in parts:
                        compact = np.full(size, -1, np.int64)
                        compact[own] = np.arange(len(own))
                        row = compact[place]
                        here = row >= 0
                        dense = np.zeros((len(own), tile.num_rows))
                        dense[row[here], doc[here]] = impact[here]
                        total += (matrix @ dense).astype(np.int64)
                    for i, item in enumerate(items.tolist()):
                        old = held.get(item)
                        bar = old[0][-1] if old is not None and len(old[0]) == k else 1
                        new = np.flatnonzero(total[i] >= bar)
                        if len(new) == 0:
                            continue
                        got = (total[i][new], ids[new], nulls[new])
                        if old is not None:
                            got = tuple(np.concatenate(x) for x in zip(old, got))
                        order = _best(*got, k)
                        held[item] = tuple(x[order] for x in got)
        for item, (score, ids, nulls) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), item, np.int64)), pa.array(ids.astype(np.int64), mask=nulls), pa.array(score)],
                names=["item", "doc_id", "score"])

    return found.mapInArrow(work, "item long, doc_id long, score long")


def _top(rows: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(docs: DataFrame, items: list[tuple], k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score) of one group of (place, text) items over all documents."""
    spark = docs.sparkSession
    counts = [(i, Counter(item_terms(text))) for i, text in items]
    vocabulary = sorted(set().union(*(c.keys() for _, c in counts)))
    place = {t: i for i, t in enumerate(vocabulary)}
    found = scratch(postings(docs, vocabulary, id_col, text_col))
    n_docs, n_terms = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most the vocabulary
    weights = {i: weight(n_docs, c) for i, c in holding.items()}
    weighted = [(i, {place[t]: q * weights[place[t]] for t, q in c.items() if weights.get(place[t])}) for i, c in counts]
    shared = spark.sparkContext.broadcast(tiles([x for x in weighted if x[1]]))
    return scored(found, shared, n_docs, n_terms, len(vocabulary), k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item."""
    query = scratch(items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"),
                                 F.monotonically_increasing_id().alias("item")))
    # A term and the character that ends it take two bytes at least.
    size = query.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = size // 2 // group_terms + 1
    out = None
    for g in range(groups):
        own = query.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).select("item", "text")
        rows = own.collect()  # one group, sized above
        if rows:
            part = _searched(docs, [(r.item, r.text) for r in rows], k, id_col, text_col)
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    first = _top(out.withColumn("part", F.spark_partition_id() % _MERGE), ["item", "part"], k)
    best = _top(first.select("item", "doc_id", "score"), ["item"], k)
    return best.join(query.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
