"""Ridge and lasso over sparse standardised rows, without a Gram matrix.

All that leaves the tasks are sums of the size of the model (columns x targets). One pass over the training
rows gives Z'ZP for a matrix P of that size; rows stay sparse: a row's Z times P is its numbers times P, plus
P_j / s_j for its terms, less one constant row for the centring. Both fits use nothing else:

- ridge: conjugate gradient on (Z'Z + alpha I) W = Z'Y, all alphas and targets as columns side by side; a
  column leaves once its residual is small.
- lasso: accelerated proximal steps with restart for all alphas and targets, until the duality gap is small.
  Gap-safe screening drops columns of Z that must be zero in every solution that is left; then the few
  columns that are not zero are solved for exactly by conjugate gradient, and kept where all signs agree.

P goes to the tasks by broadcast. Its size is bounded by ``VALUES``: with more columns times targets, targets
are fitted in groups one after the other (a single target needs 8 bytes per column of Z).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.metrics import r2_score
from playlens.operators.sparse import Scaled

VALUES = 1 << 23  # of P in one pass: 64 MiB
BLOCK = 1024  # columns of Z per block of partial sums
_CHUNK = 2048  # rows per array pass


@dataclass
class Frame:
    """Statistics of the columns of Z (scale 1, mean 0 for the numbers) and of Y; all of the model's size."""

    width: int
    mu: np.ndarray
    scale: np.ndarray
    n: int
    y_mean: np.ndarray
    y_square: np.ndarray  # squared norm of each centred target


def frame(scaled: Scaled, y_col: str = "features") -> Frame:
    mu, scale = np.zeros(scaled.size), np.ones(scaled.size)
    for r in scaled.terms.toLocalIterator():  # one row per term, as the model has
        mu[scaled.width + r.idx], scale[scaled.width + r.idx] = r.mu, r.scale
    cells = scaled.train.select(F.posexplode(y_col).alias("pos", "y")).groupBy("pos").agg(
        F.count("*").alias("n"), F.avg("y").alias("m"), (F.var_pop(F.col("y").cast("double")) * F.count("*")).alias("s")).orderBy("pos").collect()
    return Frame(scaled.width, mu, scale, cells[0].n if cells else 0, np.array([r.m for r in cells]), np.array([r.s for r in cells]))


def _entries(batch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, positions of all terms in Z, start of each row's terms)."""
    nums = batch.column("nums").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, width)
    terms = batch.column("terms")
    counts = np.diff(terms.offsets.to_numpy())
    return nums, terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + width, np.concatenate([[0], np.cumsum(counts)])


def _times(nums: np.ndarray, terms: np.ndarray, first: np.ndarray, p: np.ndarray, scaled_p: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Z times P for some rows; ``scaled_p`` is P / s and ``shift`` the constant row of the centring."""
    out = nums @ p[: nums.shape[1]] - shift
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] += np.add.reduceat(scaled_p[terms], first[some], axis=0)
    return out


def _add_back(total: np.ndarray, nums: np.ndarray, terms: np.ndarray, first: np.ndarray, u: np.ndarray) -> None:
    """Adds the rows' entries times u to the sums of the columns (terms unscaled and uncentred)."""
    total[: nums.shape[1]] += nums.T @ u
    if len(terms):
        order = np.argsort(terms, kind="stable")
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
        at = np.flatnonzero(np.concatenate([[True], np.diff(terms[order]) > 0]))
        total[terms[order][at]] += np.add.reduceat(u[row], at, axis=0)


def _summed(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """The sum of partial matrices given as (block, values), added up in tasks, block by block."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, values in zip(batch.column("block").to_pylist(), batch.column("values")):
                v = values.values.to_numpy(zero_copy_only=False)
                held[block] = held[block] + v if block in held else v.copy()
        for block, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([v], pa.list_(pa.float64()))], names=["block", "values"])

    blocks = -(-rows // BLOCK)
    tasks = min(blocks, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros((rows, columns))
    for r in parts.repartition(tasks, "block").mapInArrow(add, "block int, values array<double>").collect():  # the size of the model
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.array(r["values"]).reshape(-1, columns)
    return out


def _partials(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in range(-(-len(total) // BLOCK)):
        part = total[block * BLOCK : (block + 1) * BLOCK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.ravel()], pa.list_(pa.float64()))],
                                             names=["block", "values"])


def _pass(rows: DataFrame, stats: Frame, columns: int, u_of: Callable, also: list[str]) -> np.ndarray:
    """Z'U over all rows, U = ``u_of(batch slice, numbers, terms, first)`` per slice of rows."""
    width, size = stats.width, len(stats.mu)

    def work(batches):
        total = np.zeros((size + 1, columns))  # the last row sums U for the centring
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                nums, terms, first = _entries(part, width)
                u = u_of(part, nums, terms, first)
                _add_back(total[:-1], nums, terms, first, u)
                total[-1] += u.sum(0)
        yield from _partials(total)

    parts = rows.select("nums", "terms", *also).mapInArrow(work, "block int, values array<double>")
    total = _summed(parts, size + 1, columns)
    return (total[:-1] - stats.mu[:, None] * total[-1]) / stats.scale[:, None]


def cross_product(scaled: Scaled, stats: Frame, y_col: str = "features") -> np.ndarray:
    """Z'Y with Y centred: columns x targets."""
    mean = stats.y_mean

    def centred(part, nums, terms, first):
        y = part.column(y_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
        return y - mean

    return _pass(scaled.train, stats, len(mean), centred, [y_col])


def normal_product(scaled: Scaled, stats: Frame, p: np.ndarray) -> np.ndarray:
    """Z'ZP by one pass over the rows."""
    over = p / stats.scale[:, None]
    shared = scaled.train.sparkSession.sparkContext.broadcast((p[: stats.width], over, stats.mu @ over))

    def product(part, nums, terms, first):
        head, scaled_p, shift = shared.value
        return _times(nums, terms, first, head, scaled_p, shift)

    out = _pass(scaled.train, stats, p.shape[1], product, [])
    shared.destroy()
    return out


def conjugate_gradient(apply: Callable, b: np.ndarray, shift: np.ndarray, tol: float = 1e-11, max_iter: int = 1000,
                       mask: np.ndarray | None = None, start: np.ndarray | None = None) -> np.ndarray:
    """Solve (A + shift I) W = b column by column, ``apply(P, columns)`` giving AP for those columns.

    With ``mask`` the system is the one of the masked entries of each column, and the rest is 0.
    """
    mask = np.ones(b.shape, bool) if mask is None else mask
    w = np.zeros_like(b) if start is None else np.where(mask, start, 0.0)
    r = np.where(mask, b, 0.0)
    if start is not None:
        every = np.arange(b.shape[1])
        r = np.where(mask, r - apply(w, every) - shift * w, 0.0)
    p, rr = r.copy(), (r * r).sum(0)
    goal = tol**2 * np.maximum((np.where(mask, b, 0.0) ** 2).sum(0), 1e-300)
    for _ in range(max_iter):
        left = np.flatnonzero(rr > goal)
        if len(left) == 0:
            break
        q = np.where(mask[:, left], apply(p[:, left], left) + shift[left] * p[:, left], 0.0)
        pq = (p[:, left] * q).sum(0)
        step = np.where(pq > 0, rr[left] / np.where(pq > 0, pq, 1), 0.0)
        w[:, left] += step * p[:, left]
        r[:, left] -= step * q
        new = np.where(pq > 0, (r[:, left] ** 2).sum(0), 0.0)  # a direction without extent: nothing is left to gain
        p[:, left] = r[:, left] + (new / np.where(rr[left] > 0, rr[left], 1)) * p[:, left]
        rr[left] = new
    return w


def _groups(size: int, columns: int) -> list[np.ndarray]:
    step = max(1, VALUES // max(size, 1))
    return [np.arange(at, min(at + step, columns)) for at in range(0, columns, step)]


def ridge(scaled: Scaled, stats: Frame, b: np.ndarray, alphas: list[float]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per alpha (W, intercept): min ||y - Zw - c||^2 + alpha ||w||^2 for every target."""
    r = b.shape[1]
    shift, every = np.repeat(np.asarray(alphas, float), r), np.tile(b, len(alphas))
    w = np.zeros_like(every)
    for group in _groups(len(b), every.shape[1]):
        w[:, group] = conjugate_gradient(lambda p, _: normal_product(scaled, stats, p), every[:, group], shift[group])
    return [(w[:, i * r : (i + 1) * r], stats.y_mean) for i in range(len(alphas))]


def _shrink(v: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(v) * np.maximum(np.abs(v) - by, 0.0)


def largest_eigenvalue(scaled: Scaled, stats: Frame, steps: int = 12) -> float:
    """Of Z'Z, from a few block power steps with a margin; the steps of the lasso guard against a low value."""
    v = np.random.default_rng(0).standard_normal((len(stats.mu), 4))
    top = 0.0
    for _ in range(steps):
        v = np.linalg.qr(v)[0]
        hv = normal_product(scaled, stats, v)
        was, top = top, float(np.linalg.norm(v.T @ hv, 2))
        v = hv
        if top == 0 or abs(top - was) < 1e-3 * top:
            break
    return 1.02 * top


def _lasso_group(apply: Callable, b: np.ndarray, lam: np.ndarray, y_square: np.ndarray, norms: np.ndarray, n: int, top: float,
                 max_iter: int, tol: float) -> np.ndarray:
    """Columns of min (1/2n) ||y - Zw||^2 + lam ||w||_1, from Z'Z (``apply``) and b = Z'y alone."""
    d, m = b.shape
    w = np.zeros((d, m))
    alive = np.ones((d, m), bool)
    left = np.flatnonzero(np.abs(b).max(axis=0, initial=0.0) > lam * n)  # elsewhere zero is the solution
    v, momentum = w.copy(), np.ones(m)
    lips = np.full(m, max(top, 1e-300))
    for it in range(max_iter):
        if len(left) == 0:
            break
        hv = apply(v[:, left], left)
        grad = hv - b[:, left]  # n times the gradient
        # Duality gap at v, and the sphere that holds the dual solution.
        residual = np.maximum(y_square[left] - 2 * (v[:, left] * b[:, left]).sum(0) + (v[:, left] * hv).sum(0), 0.0)
        edge = np.maximum(lam[left] * n, np.abs(grad).max(axis=0))
        primal = residual / (2 * n) + lam[left] * np.abs(v[:, left]).sum(0)
        y_res = y_square[left] - (v[:, left] * b[:, left]).sum(0)
        scale = 1 / edge  # dual point: residual * scale
        far = residual * scale**2 - 2 * scale * y_res / (lam[left] * n) + y_square[left] / (lam[left] * n) ** 2
        gap = np.maximum(primal - (y_square[left] / (2 * n) - lam[left] ** 2 * n / 2 * far), 0.0)
        radius = np.sqrt(2 * gap / n) / lam[left]
        alive[:, left] &= np.abs(grad) * scale + radius * norms[:, None] >= 1 - 1e-9
        step = lips[left]
        new = np.where(alive[:, left], _shrink(v[:, left] - grad / step, lam[left] * n / step), 0.0)
        # Restart a column whose step turned against its momentum.
        turn = ((v[:, left] - new) * (new - w[:, left])).sum(0) > 0
        t = np.where(turn, 1.0, momentum[left])
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v[:, left] = np.where(turn, new, new + (t - 1) / after * (new - w[:, left]))
        momentum[left] = after
        w[:, left] = new
        left = left[gap > tol * np.maximum(y_square[left] / (2 * n), 1e-300)]
    return w


def _polished(apply: Callable, w: np.ndarray, b: np.ndarray, lam: np.ndarray, n: int) -> np.ndarray:
    """The exact solution on the entries that are not zero, where it keeps their signs and the optimality of the others."""
    mask = w != 0
    signs = np.sign(w)
    exact = conjugate_gradient(lambda p, cols: apply(p, cols), b - lam * n * signs, np.zeros(w.shape[1]), mask=mask, start=w, max_iter=200)
    grad = apply(exact, np.arange(w.shape[1])) - b
    holds = (np.where(mask, np.sign(exact) == signs, np.abs(grad) <= lam * n * (1 + 1e-9))).all(axis=0)
    return np.where(holds, exact, w)


def lasso(scaled: Scaled, stats: Frame, b: np.ndarray, alphas: list[float], max_iter: int = 2000,
          tol: float = 1e-9) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per alpha (W, intercept): min (1/2n) ||y - Zw - c||^2 + alpha ||w||_1 for every target."""
    r, n = b.shape[1], max(stats.n, 1)
    lam, every, square = np.repeat(np.asarray(alphas, float), r), np.tile(b, len(alphas)), np.tile(stats.y_square, len(alphas))
    top = largest_eigenvalue(scaled, stats)
    spread = np.where(np.arange(len(b)) < stats.width, 1.0, np.sqrt(stats.mu * (1 - stats.mu)) / stats.scale)
    norms = np.sqrt(n) * spread * (1 + 1e-9)  # a number's column has norm sqrt(n), or 0 if it is constant

    def apply(p, _):
        return normal_product(scaled, stats, p)

    w = np.zeros_like(every)
    for g in _groups(len(b), every.shape[1]):
        found = _lasso_group(apply, every[:, g], lam[g], square[g], norms, n, top, max_iter, tol)
        some = np.flatnonzero(found.any(axis=0))
        if len(some):
            found[:, some] = _polished(apply, found[:, some], every[:, g][:, some], lam[g][some], n)
        w[:, g] = found
    return [(w[:, i * r : (i + 1) * r], stats.y_mean) for i in range(len(alphas))]


# --------------------------------------------------------------------------------------------
# Scores and optimality


def ridge_residual(scaled: Scaled, stats: Frame, b: np.ndarray, w: np.ndarray, alpha: float) -> float:
    """Largest entry of Z'(Y - ZW) - alpha W, as a share of the largest of Z'Y: 0 at the solution."""
    return float(np.abs(b - normal_product(scaled, stats, w) - alpha * w).max(initial=0.0) / max(np.abs(b).max(initial=0.0), 1e-300))


def lasso_residual(scaled: Scaled, stats: Frame, b: np.ndarray, w: np.ndarray, alpha: float) -> float:
    """Largest violation of the subgradient conditions, as a share of the largest of Z'Y: 0 at the solution."""
    pull = b - normal_product(scaled, stats, w)
    off = np.where(w != 0, np.abs(pull - alpha * stats.n * np.sign(w)), np.maximum(np.abs(pull) - alpha * stats.n, 0.0))
    return float(off.max(initial=0.0) / max(np.abs(b).max(initial=0.0), 1e-300))


def evaluate(rows: DataFrame, stats: Frame, models: list[tuple[str, float, np.ndarray, np.ndarray]], y_col: str = "features") -> DataFrame:
    """(model, alpha, mse, rmse, r2) of (name, alpha, W, intercept) models on ``rows``, in one pass over them.

    Each task sends the sums of its rows: one row per model and target. Weights are broadcast model by model
    within the size bound; more models take more passes.
    """
    spark = rows.sparkSession
    fits = max(1, VALUES // max(len(stats.mu) * max(len(stats.y_mean), 1), 1))
    schema = "model string, alpha double, pos int, ss_res double, sy double, syy double, n long"
    parts = None
    for at in range(0, len(models), fits):
        own = models[at : at + fits]
        w = np.concatenate([m[2] for m in own], axis=1)
        over = w / stats.scale[:, None]
        shared = spark.sparkContext.broadcast((w[: stats.width], over, stats.mu @ over, [(m[0], m[1], m[3]) for m in own]))
        width, centre = stats.width, stats.y_mean

        def work(batches, shared=shared):
            head, scaled_w, shift, names = shared.value
            res, sy, syy, n = np.zeros((len(names), len(centre))), np.zeros(len(centre)), np.zeros(len(centre)), 0
            for batch in batches:
                for i in range(0, batch.num_rows, _CHUNK):
                    part = batch.slice(i, _CHUNK)
                    y = part.column(y_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
                    guess = _times(*_entries(part, width), head, scaled_w, shift).reshape(part.num_rows, len(names), -1)
                    for k, (_, _, intercept) in enumerate(names):
                        res[k] += ((y - guess[:, k] - intercept) ** 2).sum(0)
                    moved = y - centre
                    sy, syy, n = sy + moved.sum(0), syy + (moved**2).sum(0), n + part.num_rows
            for k, (name, alpha, _) in enumerate(names) if n else ():
                m = len(centre)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * m), pa.array([alpha] * m, pa.float64()), pa.array(range(m), pa.int32()), pa.array(res[k]), pa.array(sy),
                     pa.array(syy), pa.array([n] * m, pa.int64())], names=["model", "alpha", "pos", "ss_res", "sy", "syy", "n"])

        some = rows.select("nums", "terms", y_col).mapInArrow(work, schema)
        parts = some if parts is None else parts.unionByName(some)
    if parts is None:
        parts = spark.createDataFrame([], schema)
    sums = parts.groupBy("model", "alpha", "pos").agg(*[F.sum(c).alias(c) for c in ("ss_res", "sy", "syy", "n")])
    r2 = r2_score(F.col("ss_res"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"), F.col("syy"))
    return sums.groupBy("model", "alpha").agg(
        F.round(F.sum("ss_res") / F.sum("n"), 6).alias("mse"), F.round(F.sqrt(F.sum("ss_res") / F.sum("n")), 6).alias("rmse"),
        F.round(F.avg(r2), 6).alias("r2"))


def fit_grid(scaled: Scaled, alphas: list[float], kinds: tuple[str, ...] = ("ridge", "lasso"), lasso_iter: int = 2000,
             y_col: str = "features") -> tuple[Frame, np.ndarray, list[tuple[str, float, np.ndarray, np.ndarray]]]:
    """(statistics, Z'Y, models) for every kind and alpha."""
    stats = frame(scaled, y_col)
    b = cross_product(scaled, stats, y_col)
    models = []
    if "ridge" in kinds:
        models += [("ridge", float(a), *m) for a, m in zip(alphas, ridge(scaled, stats, b, alphas))]
    if "lasso" in kinds:
        models += [("lasso", float(a), *m) for a, m in zip(alphas, lasso(scaled, stats, b, alphas, lasso_iter))]
    return stats, b, models
