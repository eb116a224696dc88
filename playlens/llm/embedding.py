"""Embedding near-duplicates by PCA-ordered tiled comparison.

1. Equal vectors of one label are one class with a multiplicity.
2. The second-moment matrix of the unit vectors is summed in Spark (its size is the square of the
   dimension) and its eigenvectors, by falling eigenvalue, give the order of the dimensions.
3. Classes are dealt to cells by their leading coordinates. Unit vectors with cosine t differ by at most
   ``sqrt(2 - 2 t)`` in any coordinate, so with cells of that width only neighbouring cells can link. Cells
   are cut into tiles of at most about ``TILE`` classes, and every pair of tiles is a task's group.
4. Inside a pair of tiles, products are accumulated over blocks of leading dimensions; a pair is dropped
   once its partial product plus the product of the two suffix norms cannot reach the threshold. What is
   left takes the exact test, the cosine of the original vectors in double precision.
5. A tile pair returns a link count per class and a spanning forest of its links, never a list of pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows without
a label or id, link with nothing; vectors of different lengths never link; rows that repeat are vectors of
their own; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import runs, scratch
from playlens.llm.components import components

THRESHOLD = 0.93
TILE = 2048
CELL_DIMS = 2
STEP = 16
SLACK = 1e-9  # rounding of the bounds; the last test is exact


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps the squares of tiny and huge values finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches):
    """(d, cell, value) of the sum of outer products of the unit vectors in a task."""
    sums: dict = {}
    for group in runs(batches, ["d"]):
        d = group.column("d")[0].as_py()
        u = _unit(_matrix(group.column("v")))
        sums[d] = sums.get(d, 0) + u.T @ u
    for d, s in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int32)), pa.array(s.ravel())],
            names=["d", "cell", "value"])


def rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length its principal directions as columns, strongest first."""
    rows = classes.select("d", "v").mapInArrow(_moments, "d int, cell int, value double").groupBy("d", "cell").agg(
        F.sum("value").alias("value")).collect()  # squares of the few vector lengths
    out = {}
    for d in {r.d for r in rows}:
        m = np.zeros(d * d)
        for r in rows:
            if r.d == d:
                m[r.cell] = r.value
        out[d] = np.linalg.eigh(m.reshape(d, d))[1][:, ::-1].copy()
    return out


def _placed(turn: dict, width: float):
    """Adds the cell of each class: its leading coordinates over ``width``."""

    def work(batches):
        for batch in batches:
            cells: list = [None] * batch.num_rows
            ds = batch.column("d").to_numpy()
            for d in np.unique(ds):
                at = np.flatnonzero(ds == d)
                lead = _unit(_matrix(batch.column("v").take(pa.array(at)))) @ turn[int(d)][:, :CELL_DIMS]
                for i, c in zip(at.tolist(), np.floor(lead / width).astype(np.int32).tolist()):
                    cells[i] = c + [0] * (CELL_DIMS - len(c))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "cell"])

    return work


def _compare(turn: dict, threshold: float):
    """Per tile pair: rows (node, links, None) and forest edges (node, None, other)."""

    def work(batches):
        for group in runs(batches, ["pair"]):
            rep, n, side = (group.column(c).to_numpy() for c in ("rep", "n", "side"))
            d = group.column("d")[0].as_py()
            raw = _matrix(group.column("v"))
            unit = _unit(raw)
            z = unit @ turn[d]
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # 2: the pair of a tile with itself
            rest = np.sqrt(np.maximum(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1], 0))
            found_i, found_j = [], []
            for at in range(0, len(left), 512):
                rows = left[at : at + 512]
                done = min(STEP, d)
                part = z[rows, :done] @ z[right, :done].T
                limit = part if done >= d else part + np.outer(rest[rows, done], rest[right, done])
                i, j = np.nonzero(limit >= threshold - SLACK)
                i, value, j = rows[i], part[i, j], right[j]
                keep = (i < j) if side[0] == 2 else np.ones(len(i), bool)
                i, j, value = i[keep], j[keep], value[keep]
                while done < d and len(i):
                    more = min(done + STEP, d)
                    value = value + np.einsum("ij,ij->i", z[i, done:more], z[j, done:more])
                    done = more
                    bound = value if done >= d else value + rest[i, done] * rest[j, done]
                    keep = bound >= threshold - SLACK
                    i, j, value = i[keep], j[keep], value[keep]
                exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                found_i.append(i[exact])
                found_j.append(j[exact])
            i, j = np.concatenate(found_i or [[]]).astype(int), np.concatenate(found_j or [[]]).astype(int)
            links = np.bincount(i, n[j], len(rep)) + np.bincount(j, n[i], len(rep))
            up = list(range(len(rep)))

            def top(k):
                while up[k] != k:
                    up[k] = up[up[k]]
                    k = up[k]
                return k

            a, b = [], []
            for x, y in zip(i.tolist(), j.tolist()):
                p, q = top(x), top(y)
                if p != q:
                    up[max(p, q)] = min(p, q)
                    a.append(rep[x])
                    b.append(rep[y])
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rep[some], np.array(a, np.int64)]).astype(np.int64)),
                 pa.array(links[some].astype(np.int64).tolist() + [None] * len(a), pa.int64()),
                 pa.array([None] * len(some) + b, pa.int64())], names=["node", "links", "other"])

    return work


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``; links only inside a label."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False)))
    good = rows.where("ok").select("vec_id", "label", "v", F.xxhash64("label", "v").alias("h"))
    classes = scratch(good.groupBy("label", "h", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn(
        "d", F.size("v")))
    turn = rotations(classes)
    width = float(np.sqrt(max(2 - 2 * threshold, 0)) * (1 + 1e-6)) or 1e-6
    schema = "label string, d int, rep long, n long, v array<double>, cell array<int>"
    placed = scratch(classes.select("label", "d", "rep", "n", "v").mapInArrow(_placed(turn, width), schema))

    cells = placed.groupBy("label", "d", "cell").agg(F.count("*").alias("size"))
    cells = cells.select("label", "d", "cell", F.ceil(F.col("size") / tile).cast("int").alias("cuts"))
    tiles = cells.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn(
        "tile", F.struct("cell", "cut")).select("label", "d", "cell", "tile")
    near = F.array(*[F.array(*steps) for steps in _steps(CELL_DIMS)])
    reach = tiles.select("label", "d", F.col("tile").alias("one"), F.explode(F.transform(near, lambda s: F.zip_with(
        "cell", s, lambda c, x: c + x))).alias("cell"))
    pairs = reach.join(tiles.withColumnRenamed("tile", "two"), ["label", "d", "cell"]).where("one <= two").select(
        "label", "d", "one", "two", F.xxhash64("label", "d", "one", "two").alias("pair"))
    sides = pairs.select("label", "d", "pair", F.explode(F.when(F.col("one") == F.col("two"), F.array(
        F.struct(F.col("one").alias("tile"), F.lit(2).alias("side")))).otherwise(F.array(
            F.struct(F.col("one").alias("tile"), F.lit(0).alias("side")),
            F.struct(F.col("two").alias("tile"), F.lit(1).alias("side"))))).alias("s")).select(
                "label", "d", "pair", "s.tile", "s.side")
    tiled = placed.join(cells, ["label", "d", "cell"]).withColumn(
        "tile", F.struct("cell", F.pmod(F.xxhash64("rep"), "cuts").cast("int").alias("cut")))
    dealt = tiled.join(sides, ["label", "d", "tile"]).select("pair", "side", "d", "rep", "n", "v")
    found = scratch(dealt.repartition("pair").sortWithinPartitions("pair", "side", "rep").mapInArrow(
        _compare(turn, threshold), "node long, links long, other long"))

    links = found.where("links is not null").groupBy(F.col("node").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null"), "node", "other").select(F.col("node").alias("rep"), "root")
    known = classes.select("label", "h", "v", "rep", "n").join(links, "rep", "left").join(roots, "rep", "left").select(
        F.col("label").alias("l"), F.col("h").alias("g"), F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"))
    full = good.join(known, (F.col("h") == F.col("g")) & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w"))).select(
        "vec_id", "n_links", "component_id")
    rest = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return full.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _steps(dims: int) -> list[list]:
    """All offsets of -1, 0, 1 in ``dims`` dimensions, as literals."""
    out: list[list] = [[]]
    for _ in range(dims):
        out = [[*o, s] for o in out for s in (-1, 0, 1)]
    return [[F.lit(s) for s in o] for o in out]
