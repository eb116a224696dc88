"""Exact 1-nearest-neighbour over sparse standardised rows (id, nums, terms).

Squared distance = squared differences of the numbers + 1 / s_j^2 for every term j that one of the two rows
has and the other has not. Rows with equal terms are a *pattern*, so the second part is a matter of patterns.

1. Equal rows are one class (the least id stands for them; ties go to the least id anyway).
2. Classes of a pattern are put in Morton order of their numbers and cut into blocks of ``BLOCK`` rows with a
   bounding box. A pattern that holds a third of all rows is many blocks over many tasks.
3. Each query gets an upper bound from the block of its own pattern that lies nearest, and from a few
   sampled rows of near patterns: its own, per term the lightest patterns that have it, and the lightest of
   all. These rows only bound; they never decide.
4. An inverted index over terms finds the patterns worth a look. If a pattern shares none of the heaviest
   terms of a query block whose weights reach the block's bound, it is too far, so only those terms are
   probed: rare terms weigh most and have short lists. A block whose whole weight is below its bound
   meets, besides, the patterns that weigh less than the two together.
5. A block pair is skipped when the pattern distance plus the distance of the boxes passes the bound.
   What is left is compared in array operations, one best per query and block pair, and a minimum by
   query ends the search.

Distances are compared rounded to 1e-9, ties go to the least reference id; bounds leave room for that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.lineage import kept
from playlens.functions.positions import positions

BLOCK = 256  # rows per block
SAMPLES = 16  # sampled rows per pattern for the bounds
PARTNERS = 2  # patterns per term, and of all, that are sampled
_BITS = 8  # per number in the Morton order
_DIGITS = 9


def term_patterns(rows: list[DataFrame], term_scales: DataFrame) -> DataFrame:
    """(pid, terms, items, total): distinct term sets, their (-weight, idx) entries by weight, and total weight."""
    distinct = rows[0].select("terms")
    for more in rows[1:]:
        distinct = distinct.unionByName(more.select("terms"))
    named = kept(distinct.distinct().withColumn("pid", F.monotonically_increasing_id()))
    weights = term_scales.select("idx", (1 / (F.col("scale") * F.col("scale"))).alias("w"))
    entries = named.select("pid", F.explode("terms").alias("idx")).join(weights, "idx", "left").groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct((-F.coalesce("w", F.lit(1.0))).alias("m"), "idx"))).alias("items"))
    none = F.array().cast("array<struct<m:double,idx:int>>")
    out = named.join(entries, "pid", "left").withColumn("items", F.coalesce("items", none))
    return kept(out.withColumn("total", F.aggregate("items", F.lit(0.0), lambda a, x: a - x["m"])))


def _morton(width: int) -> Column:
    """Interleaved bits of the numbers, each cut to [-4, 4] and 2^bits steps."""
    bits = max(1, min(_BITS, 60 // max(width, 1)))
    key = F.lit(0).cast("long")
    for i in range(width):
        unit = (F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.col("nums")[i])) + 4) / 8
        step = F.floor(unit * (2**bits - 1)).cast("long")
        for b in range(bits):
            key = key + F.shiftleft(F.shiftright(step, b).bitwiseAND(F.lit(1).cast("long")), b * width + i)
    return key


def row_blocks(rows: DataFrame, patterns: DataFrame, width: int, block_rows: int) -> DataFrame:
    """(bid, pid, n, ids, flat, lo, hi): the distinct rows by pattern, in blocks near in their numbers."""
    classes = rows.groupBy("nums", "terms").agg(F.min("id").alias("id"))
    placed = classes.join(patterns.select("pid", "terms"), "terms").select("pid", "id", "nums", _morton(width).alias("z"))
    numbered = positions(placed, ["z", "id"], ["pid"], "p")
    boxes = [f(F.col("nums")[i]).alias(f"{name}{i}") for i in range(width) for name, f in (("lo", F.min), ("hi", F.max))]
    blocks = numbered.groupBy("pid", ((F.col("p") - 1) / block_rows).cast("long").alias("b")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("id", "nums"))).alias("r"), *boxes)

    def corner(name: str) -> Column:
        return F.array(*[F.col(f"{name}{i}") for i in range(width)]) if width else F.array().cast("array<double>")

    return kept(blocks.select(
        F.monotonically_increasing_id().alias("bid"), "pid", "n", F.transform("r", lambda x: x["id"]).alias("ids"),
        F.flatten(F.transform("r", lambda x: x["nums"])).alias("flat"), corner("lo").alias("lo"), corner("hi").alias("hi")))


def _apart(a: str, b: str) -> Column:
    """Weight of the terms that one of two patterns has and the other has not: summed directly, not by difference."""
    def only(x: str, y: str) -> Column:
        return F.aggregate(F.filter(F.col(f"{x}.items"), lambda e: ~F.array_contains(F.col(f"{y}.terms"), e["idx"])),
                           F.lit(0.0), lambda s, e: s - e["m"])
    return only(a, b) + only(b, a)


def _pattern_distances(pairs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``apart``."""
    x = patterns.select(F.col("pid").alias("a"), "terms", "items").alias("x")
    y = patterns.select(F.col("pid").alias("b"), "terms", "items").alias("y")
    return pairs.join(x, "a").join(y, "b").select(*pairs.columns, _apart("x", "y").alias("apart"))


def _numbers(column, width: int) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _bounded(width: int):
    """Adds each query's squared bound, and the block's, from the sampled rows of near patterns."""

    def work(batches):
        for batch in batches:
            bound, top = [], []
            for flat, near, apart in zip(batch.column("flat"), batch.column("near"), batch.column("near_apart")):
                q = _numbers(flat.values, width) if width else np.zeros((0, 0))
                s, d = _numbers(near.values, width), apart.values.to_numpy(zero_copy_only=False)
                best = np.full(len(q), np.inf)
                for i in range(len(s)):
                    best = np.minimum(best, ((q - s[i]) ** 2).sum(1) + d[i])
                # Room for distances that are equal once rounded, and for the rounding of sums.
                best = (np.sqrt(best) + 2 * 10.0**-_DIGITS) ** 2 * (1 + 1e-12)
                bound.append(best)
                top.append(float(best.max()) if len(best) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("bid"), pa.array(bound, pa.list_(pa.float64())), pa.array(top, pa.float64())],
                                             names=["bid", "bound", "top"])

    return work


def _with_bounds(queries: DataFrame, refs: DataFrame, rows: DataFrame, patterns: DataFrame, width: int) -> DataFrame:
    """Query blocks with ``bound`` (per row) and ``top`` (their largest)."""
    held = patterns.join(refs.select("pid").distinct(), "pid", "left_semi")
    pick = Window.partitionBy("pid").orderBy(F.xxhash64("id"), "id")
    sample = (rows.join(patterns.select("pid", "terms"), "terms").select("pid", "id", "nums").withColumn("r", F.row_number().over(pick))
              .where(F.col("r") <= SAMPLES).groupBy("pid").agg(F.collect_list("nums").alias("s")))
    lightest = Window.partitionBy("idx").orderBy("total", "pid")
    by_term = held.select("pid", "total", F.explode("items.idx").alias("idx")).withColumn("r", F.row_number().over(lightest)).where(
        F.col("r") <= PARTNERS).select("idx", F.col("pid").alias("b"))
    asked = patterns.join(queries.select("pid").distinct(), "pid", "left_semi")
    few = [r.pid for r in held.orderBy("total", "pid").limit(PARTNERS).select("pid").collect()]
    partners = held.select(F.col("pid").alias("a"), F.col("pid").alias("b")).join(asked.select(F.col("pid").alias("a")), "a", "left_semi")
    partners = partners.unionByName(asked.select(F.col("pid").alias("a"), F.explode("items.idx").alias("idx")).join(by_term, "idx").select("a", "b"))
    if few:
        partners = partners.unionByName(asked.select(F.col("pid").alias("a"), F.explode(F.array(*[F.lit(p) for p in few])).alias("b")))
    near = _pattern_distances(partners.distinct(), patterns).join(sample.withColumnRenamed("pid", "b"), "b").groupBy(F.col("a").alias("pid")).agg(
        F.flatten(F.collect_list(F.transform("s", lambda v: F.struct(F.col("apart").alias("d"), v.alias("v"))))).alias("near"))
    # The block of the same pattern whose centre is nearest, whole.
    away = F.lit(0.0)
    for i in range(width):
        away = away + F.pow(F.col("lo")[i] + F.col("hi")[i] - F.col("qlo")[i] - F.col("qhi")[i], 2)
    home = queries.select("bid", "pid", F.col("lo").alias("qlo"), F.col("hi").alias("qhi")).join(
        refs.select("pid", F.col("bid").alias("r"), "lo", "hi"), "pid").groupBy("bid").agg(F.min(F.struct(away.alias("away"), "r")).alias("h"))
    home = home.select("bid", F.col("h.r").alias("r")).join(refs.select(F.col("bid").alias("r"), F.col("flat").alias("own"), "n"), "r").select(
        "bid", "own", F.array_repeat(F.lit(0.0), F.col("n").cast("int")).alias("own_apart"))
    none = F.array().cast("array<double>")
    given = queries.join(near, "pid").join(home, "bid", "left").select(
        "bid", "flat", F.concat(F.flatten(F.transform("near", lambda e: e["v"])), F.coalesce("own", none)).alias("near"),
        F.concat(F.transform("near", lambda e: e["d"]), F.coalesce("own_apart", none)).alias("near_apart"))
    bounds = given.mapInArrow(_bounded(width), "bid long, bound array<double>, top double")
    return kept(queries.join(bounds, "bid"))


def block_pairs(queries: DataFrame, refs: DataFrame, patterns: DataFrame, width: int) -> DataFrame:
    """(q, r, apart): the block pairs that may hold a nearest neighbour; ``queries`` carry ``top``."""
    held = patterns.join(refs.select("pid").distinct(), "pid", "left_semi")
    blocks = queries.select("bid", "pid", "top").join(patterns.select("pid", "items", "total"), "pid")
    # The heaviest terms whose weights reach the bound; all of them together may not.
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<int>").alias("take"))
    reach = F.aggregate("items", start, lambda acc, e: F.when(acc["sum"] >= F.col("top"), acc).otherwise(
        F.struct((acc["sum"] - e["m"]).alias("sum"), F.concat(acc["take"], F.array(e["idx"])).alias("take"))))
    blocks = blocks.withColumn("reach", reach)
    index = held.select(F.explode("items.idx").alias("idx"), F.col("pid").alias("b"))
    heavy = blocks.where(F.col("reach.sum") >= F.col("top")).select("bid", F.col("pid").alias("a"), "top", F.explode("reach.take").alias("idx"))
    light = blocks.where(F.col("reach.sum") < F.col("top")).select(
        "bid", F.col("pid").alias("a"), "top", (F.col("total") + F.col("top")).alias("most"))
    most = light.agg(F.max("most")).scalar()
    salts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light_held = held.where(F.col("total") <= most).select(F.col("pid").alias("b"), "total", F.pmod(F.xxhash64("pid"), F.lit(salts)).alias("salt"))
    any_of = light.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).join(light_held, "salt").where("total <= most")
    found = heavy.join(index, "idx").select("bid", "a", "top", "b").distinct().unionByName(any_of.select("bid", "a", "top", "b"))
    near = _pattern_distances(found, patterns).where(F.col("apart") <= F.col("top"))
    q = queries.select("bid", F.col("lo").alias("qlo"), F.col("hi").alias("qhi"))
    r = refs.select(F.col("bid").alias("r"), F.col("pid").alias("b"), "lo", "hi")
    gap = F.lit(0.0)
    for i in range(width):
        side = F.greatest(F.lit(0.0), F.col("lo")[i] - F.col("qhi")[i], F.col("qlo")[i] - F.col("hi")[i])
        gap = gap + side * side
    return near.join(q, "bid").join(r, "b").where(F.col("apart") + gap <= F.col("top")).select(F.col("bid").alias("q"), "r", "apart")


def _compare(width: int):
    """Per block pair and query: the nearest row, by rounded distance, then id."""

    def work(batches):
        for batch in batches:
            out_q, out_d, out_r = [], [], []
            columns = [batch.column(c) for c in ("apart", "ids", "flat", "bound", "r_ids", "r_flat")]
            for apart, ids, flat, bound, r_ids, r_flat in zip(*columns):
                ids, r_ids = ids.values.to_numpy(zero_copy_only=False), r_ids.values.to_numpy(zero_copy_only=False)
                q, r = _numbers(flat.values, width), _numbers(r_flat.values, width)
                square = ((q[:, None, :] - r[None, :, :]) ** 2).sum(2) + apart.as_py()
                best = square.min(axis=1)
                near = np.flatnonzero(best <= bound.values.to_numpy(zero_copy_only=False))
                d = np.round(np.sqrt(square[near]), _DIGITS)
                at = d.argmin(axis=1) if len(near) else np.zeros(0, np.int64)  # ids ascend: the first is the least
                out_q.append(ids[near])
                out_d.append(d[np.arange(len(near)), at])
                out_r.append(r_ids[at])
            if out_q:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_d)), pa.array(np.concatenate(out_r))],
                                                 names=["query", "dist", "ref_id"])

    return work


@dataclass
class Search:
    """The parts of one search: its blocks and the pairs of them that are compared."""

    queries: DataFrame
    refs: DataFrame
    pairs: DataFrame

    def work(self) -> tuple[int, int]:
        """(row pairs that are compared, row pairs of all classes)."""
        q = self.queries.select(F.col("bid").alias("q"), F.col("n").alias("nq"))
        r = self.refs.select(F.col("bid").alias("r"), F.col("n").alias("nr"))
        done = self.pairs.join(q, "q").join(r, "r").agg(F.sum(F.col("nq") * F.col("nr"))).first()[0] or 0
        return done, (q.agg(F.sum("nq")).first()[0] or 0) * (r.agg(F.sum("nr")).first()[0] or 0)


def plan_search(queries: DataFrame, refs: DataFrame, term_scales: DataFrame, width: int, block_rows: int = BLOCK) -> Search:
    queries, refs = queries.select("id", "nums", "terms"), refs.select("id", "nums", "terms")
    patterns = term_patterns([queries, refs], term_scales)
    r = row_blocks(refs, patterns, width, block_rows)
    # Queries in smaller blocks: their boxes, and so their bounds, are tighter.
    q = _with_bounds(row_blocks(queries, patterns, width, max(1, block_rows // 4)), r, refs, patterns, width)
    return Search(q, r, kept(block_pairs(q, r, patterns, width)))


def nearest_sparse(queries: DataFrame, refs: DataFrame, term_scales: DataFrame, width: int, block_rows: int = BLOCK) -> DataFrame:
    """(query_id, ref_id, dist): the nearest reference of every query; no references give no rows.

    Inputs are (id, nums, terms) with ``width`` numbers without nulls; ``term_scales`` is (idx, scale), and a
    term without a row there has scale 1.
    """
    search = plan_search(queries, refs, term_scales, width, block_rows)
    left = search.queries.select(F.col("bid").alias("q"), "ids", "flat", "bound")
    right = search.refs.select(F.col("bid").alias("r"), F.col("ids").alias("r_ids"), F.col("flat").alias("r_flat"))
    met = search.pairs.join(left, "q").join(right, "r").select("apart", "ids", "flat", "bound", "r_ids", "r_flat")
    best = met.mapInArrow(_compare(width), "query long, dist double, ref_id long").groupBy("query").agg(
        F.min(F.struct("dist", "ref_id")).alias("b"))
    # Back from classes to all rows that are equal to them.
    classes = queries.groupBy("nums", "terms").agg(F.min("id").alias("query"))
    every = queries.select("id", "nums", "terms").join(classes, ["nums", "terms"]).select(F.col("id").alias("query_id"), "query")
    return every.join(best, "query").select("query_id", F.col("b.ref_id").alias("ref_id"), F.col("b.dist").alias("dist"))


# --------------------------------------------------------------------------------------------
# Approximate search: random hyperplanes


@dataclass
class Planes:
    """Seeded random hyperplanes: ``tables`` hash tables of ``bits`` planes, and how many codes a query probes in each."""

    tables: int = 12
    bits: int = 8
    probes: int = 5
    seed: int = 0

    @property
    def count(self) -> int:
        return self.tables * self.bits


def _normal(planes: Planes, key: Column) -> Column:
    """A normal number per (plane, key), the same on every machine: Box-Muller over two hashes."""
    def unit(salt: int, p: Column) -> Column:
        return (F.shiftrightunsigned(F.xxhash64(F.lit(planes.seed), F.lit(salt), p, key), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return F.transform(F.sequence(F.lit(0), F.lit(planes.count - 1)),
                       lambda p: F.sqrt(-2 * F.log(unit(1, p))) * F.cos(2 * np.pi * unit(2, p)))


def _sides(rows: DataFrame, patterns: DataFrame, term_stats: DataFrame, width: int, planes: Planes) -> DataFrame:
    """(id, nums, pid, side): each row's signed distance to every plane, without dense rows.

    A term adds its own number over s, the centring takes one constant per plane from all rows, and the
    numbers of a row add theirs. Terms are summed once per pattern.
    """
    stats = term_stats.withColumn("g", _normal(planes, F.col("idx").cast("long") + width))

    def summed(df: DataFrame, by: list[str], each: Column) -> DataFrame:
        cells = df.select(*by, F.posexplode(each).alias("p", "v")).groupBy(*by, "p").agg(F.sum("v").alias("v"))
        return cells.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))), lambda x: x["v"]).alias("sum"))

    over = stats.select("idx", "mu", F.transform("g", lambda g: g / F.col("scale")).alias("g"))
    none = F.array_repeat(F.lit(0.0), planes.count)
    centre = F.coalesce(summed(over.select("mu", "g"), [], F.transform("g", lambda g: g * F.col("mu"))).scalar(), none)
    of_terms = summed(patterns.select("pid", F.explode("terms").alias("idx")).join(over, "idx"), ["pid"], F.col("g"))
    placed = rows.join(patterns.select("pid", "terms"), "terms").join(of_terms, "pid", "left").select(
        "id", "nums", "pid", F.coalesce("sum", none).alias("side"), centre.alias("centre"))
    side = F.zip_with("side", "centre", lambda a, c: a - c)
    for i in range(width):
        axis = _normal(planes, F.lit(i).cast("long"))
        placed = placed.withColumn("axis", axis).withColumn("side", F.zip_with("side", "axis", lambda s, g: s + F.col("nums")[i] * g)).drop("axis")
    return placed.select("id", "nums", "pid", side.alias("side"))


def _codes(planes: Planes, probes: int):
    """Rows (table, code) per row: its own code, then those across the nearest planes, one or two at a time."""

    def work(batches):
        powers = 1 << np.arange(planes.bits, dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            side = batch.column("side").flatten().to_numpy(zero_copy_only=False).reshape(n, planes.tables, planes.bits)
            own = ((side > 0) * powers).sum(2)
            order = np.argsort(np.abs(side), axis=2)
            flips = [np.zeros_like(own)]
            for i in range(min(planes.bits, probes)):
                flips.append(powers[order[:, :, i]])
            if planes.bits > 1:
                flips.append(powers[order[:, :, 0]] | powers[order[:, :, 1]])
            codes = np.stack([own ^ f for f in flips[:probes]], axis=2)
            table = np.broadcast_to(np.arange(planes.tables)[None, :, None], codes.shape)
            key = (table << planes.bits | codes).reshape(n, -1)
            ends = pa.array(np.arange(n + 1) * key.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("nums"), batch.column("pid"), pa.ListArray.from_arrays(ends, pa.array(key.ravel()))],
                names=["id", "nums", "pid", "keys"])

    return work


def nearest_hashed(queries: DataFrame, refs: DataFrame, term_stats: DataFrame, width: int, planes: Planes | None = None) -> DataFrame:
    """(query_id, ref_id, dist): a near reference for most queries, by random-hyperplane buckets with multi-probe.

    ``term_stats`` is (idx, mu, scale). A reference is in one bucket of every table, a query looks into
    ``probes`` buckets of each; the least exact distance met wins (ties: the least id). A query that meets no
    reference has no row. Equal rows are one class, so copies do not fill a bucket; rows of a bucket are
    compared in the join, which Spark splits where a bucket is large, and nothing is capped.
    """
    planes = planes or Planes()
    queries, refs = queries.select("id", "nums", "terms"), refs.select("id", "nums", "terms")
    patterns = term_patterns([queries, refs], term_stats)
    schema = "id long, nums array<double>, pid long, keys array<long>"

    def hashed(rows: DataFrame, probes: int) -> DataFrame:
        classes = rows.groupBy("nums", "terms").agg(F.min("id").alias("id"))
        return _sides(classes, patterns, term_stats, width, planes).mapInArrow(_codes(planes, probes), schema).select(
            "id", "nums", "pid", F.explode("keys").alias("key"))

    q = hashed(queries, planes.probes).select("key", F.col("id").alias("query"), F.col("nums").alias("qn"), F.col("pid").alias("a"))
    r = hashed(refs, 1).select("key", F.col("id").alias("ref_id"), "nums", F.col("pid").alias("b"))
    square = F.aggregate(F.zip_with("qn", "nums", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    # Of the rows that one query meets in one pattern only the nearest by numbers can win.
    met = kept(q.join(r, "key").groupBy("query", "a", "b").agg(F.min(F.struct(square.alias("square"), "ref_id")).alias("m")).select(
        "query", "a", "b", "m.*"))
    apart = _pattern_distances(met.select("a", "b").distinct(), patterns)
    best = met.join(apart, ["a", "b"]).groupBy("query").agg(F.min(F.struct(
        F.round(F.sqrt(F.col("square") + F.col("apart")), _DIGITS).alias("dist"), "ref_id")).alias("m"))
    classes = queries.groupBy("nums", "terms").agg(F.min("id").alias("query"))
    every = queries.join(classes, ["nums", "terms"]).select(F.col("id").alias("query_id"), "query")
    return every.join(best, "query").select("query_id", F.col("m.ref_id").alias("ref_id"), F.col("m.dist").alias("dist"))
