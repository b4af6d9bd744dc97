"""Wide designs: sparse rows, pair statistics and solvers without a p x p matrix.

A row of a design with many categories holds a handful of non-zero entries. Here it is two
arrays (places and values). Categories are numbered in a table, not in the plan, so their
number has no bound but the length of a weight vector; it is joined by value, and the
planner broadcasts it while it is small.

Two forms of the least-squares statistics of Z = [1, x, y] answer the same question, the
product Z'Z v for a block of vectors v:

* ``PairGram``: the non-zero entries of Z'Z, added up in one pass over the rows (pairs of a
  row's places, combined in the tasks) and small enough to keep;
* ``RowGram``: one pass over the rows for each product, which never forms a pair.

Ridge is solved by conjugate gradients and lasso and elastic net by accelerated proximal
gradients, all points of a grid in the same passes. Both use nothing but products.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.operators.features import BINARY, CATEGORICAL, INTERACTION, NUMERIC
from cabline.operators.linear import LinearFit
from cabline.operators.ranking import global_row_number
from cabline.session import materialize

#: Pairs that a task adds up before it passes them on.
TASK_PAIRS = 1 << 21


@dataclass
class SparsePreprocessor:
    """The design of ``features.Preprocessor`` with the same columns in the same order, as
    sparse rows and for any number of categories.

    places: table (column, value, place) of the training categories, written to the shared
    folder. width: columns of the design. An unseen or NULL category adds no entry.
    """

    numeric: Sequence[str] = tuple(NUMERIC)
    categorical: Sequence[str] = tuple(CATEGORICAL)
    binary: Sequence[str] = tuple(BINARY)
    interaction: tuple[str, str] | None = INTERACTION
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    places: DataFrame | None = None
    categories: int = 0

    @property
    def width(self) -> int:
        return len(self.numeric) + self.categories + len(self.binary) + (3 if self.interaction else 0)

    def fit(self, train: DataFrame) -> SparsePreprocessor:
        if self.numeric:
            row = train.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(self.numeric) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
            self.means = {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(self.numeric)}
            self.stds = {c: float(row[f"s_{i}"] or 0.0) for i, c in enumerate(self.numeric)}
        if self.categorical:
            named = [F.struct(F.lit(k).alias("at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for k, c in enumerate(self.categorical)]
            seen = train.select(F.inline(F.array(*named))).where("value IS NOT NULL").distinct()
            ranked = global_row_number(seen, [F.asc("at"), F.asc("value")])
            place = (F.col("_rn") - 1 + len(self.numeric)).cast("int")
            self.places = materialize(ranked.select("column", "value", place.alias("place")), "places")
            self.categories = self.places.count()
        return self

    def names(self, spark) -> DataFrame:
        """(place, name) of every design column, named as the dense design names them."""
        fixed = list(enumerate(self.numeric))
        at = len(self.numeric) + self.categories
        more = [*self.binary, *([*self.interaction, " ".join(self.interaction)] if self.interaction else [])]
        frame = spark.createDataFrame(fixed + list(enumerate(more, at)), "place int, name string")
        if self.places is None:
            return frame
        return frame.unionByName(self.places.select("place", F.concat("column", F.lit("="), "value").alias("name")))

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns, ``at`` (places, ascending) and ``v`` (values; zeros left out)."""
        scaled = {c: (F.col(c).cast("double") - self.means[c]) / (self.stds[c] if self.stds[c] > 0 else 1.0) for c in self.numeric}
        out = df
        for k, c in enumerate(self.categorical):
            one = self.places.where(F.col("column") == c).select(F.col("value").alias(f"_v{k}"), F.col("place").alias(f"_p{k}"))
            out = out.join(one, out[c].cast("string") == one[f"_v{k}"], "left")
        entries = [(F.lit(i), scaled[c]) for i, c in enumerate(self.numeric)]
        entries += [(F.col(f"_p{k}"), F.lit(1.0)) for k in range(len(self.categorical))]
        at = len(self.numeric) + self.categories
        entries += [(F.lit(at + i), F.col(c).cast("double")) for i, c in enumerate(self.binary)]
        if self.interaction:
            a, b = (scaled[c] for c in self.interaction)
            entries += [(F.lit(at + len(self.binary) + i), e) for i, e in enumerate((a, b, a * b))]
        pairs = F.filter(F.array(*[F.struct(p.cast("int").alias("p"), e.alias("e")) for p, e in entries]),
                         lambda x: x["p"].isNotNull() & (x["e"] != 0))
        return out.select(*keep, pairs.alias("_x")).select(*keep, F.col("_x.p").alias("at"), F.col("_x.e").alias("v"))


# ------------------------------------------------------------ statistics


def _augmented(batch, p: int):
    """Rows of Z = [1, x, y] in one batch: pointers, places (x shifted by 1), values."""
    n = batch.num_rows
    off = np.asarray(batch.column("at").offsets, dtype=np.int64)
    at = np.asarray(batch.column("at").values, dtype=np.int64)[off[0]: off[-1]]
    v = np.asarray(batch.column("v").values, dtype=float)[off[0]: off[-1]]
    size = np.diff(off)
    ptr = np.concatenate([[0], np.cumsum(size + 2)])
    places, values = np.empty(ptr[-1], np.int64), np.empty(ptr[-1])
    places[ptr[:-1]], values[ptr[:-1]] = 0, 1.0
    places[ptr[1:] - 1], values[ptr[1:] - 1] = p + 1, np.asarray(batch.column("y"), dtype=float)
    inner = np.arange(len(at)) + 2 * np.repeat(np.arange(n), size) + 1
    places[inner], values[inner] = at + 1, v
    return ptr, places, values


def _added(keys: np.ndarray, sums: np.ndarray):
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which, sums, len(distinct))


def _pair_sums(p: int):
    """Per task: (g, i, j, v), the sums of z_i z_j over its rows for the pairs i <= j that occur."""
    side = p + 2

    def flush(sums):
        for g, (keys, v) in sums.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([g] * len(keys), pa.string()), pa.array(keys // side, pa.int32()), pa.array(keys % side, pa.int32()), pa.array(v)],
                names=["g", "i", "j", "v"])

    def run(batches):
        sums: dict = {}
        for whole in batches:
            for a in range(0, whole.num_rows, 4_096):
                batch = whole.slice(a, 4_096)
                ptr, places, values = _augmented(batch, p)
                group = batch.column("g").dictionary_encode()
                codes = np.asarray(group.indices)
                m = np.diff(ptr)
                for size in np.unique(m):                          # rows of one length: all pairs at once
                    rows = np.flatnonzero(m == size)
                    i, j = np.triu_indices(size)
                    block = ptr[rows][:, None] + np.arange(size)
                    keys = places[block[:, i]] * side + places[block[:, j]]
                    products = values[block[:, i]] * values[block[:, j]]
                    for k, g in enumerate(group.dictionary.to_pylist()):
                        mine = codes[rows] == k
                        if mine.any():
                            new = _added(keys[mine].ravel(), products[mine].ravel())
                            old = sums.get(g)
                            sums[g] = new if old is None else _added(np.append(old[0], new[0]), np.append(old[1], new[1]))
                if sum(len(k) for k, _ in sums.values()) > TASK_PAIRS:
                    yield from flush(sums)
                    sums = {}
        yield from flush(sums)

    return run


def _source(df: DataFrame, group: str | None = None) -> DataFrame:
    g = F.col(group).cast("string") if group else F.lit("all")
    src = df.select(g.alias("g"), F.col("at"), F.col("v"), F.col("y").cast("double").alias("y"))
    return src.where("g IS NOT NULL AND y IS NOT NULL")


def pair_gram(df: DataFrame, p: int, group: str | None = None) -> DataFrame:
    """(g, i, j, v): the non-zero entries i <= j of Z'Z per group, Z = [1, x, y] (column 0 is
    the ones, 1..p the design, p + 1 the target). Rows with a NULL group or target are left
    out. Every group needs a pass over the same rows only."""
    return _source(df, group).mapInArrow(_pair_sums(p), "g string, i int, j int, v double").groupBy("g", "i", "j").agg(F.sum("v").alias("v"))


class _Products:
    """What the solvers need: ``product(v)`` = Z'Z v for v of shape (p + 2, k)."""

    p: int

    def moments(self) -> None:
        ends = np.zeros((self.p + 2, 2))
        ends[0, 0] = ends[-1, 1] = 1.0
        m = self.product(ends)
        self.n, self.sx, self.sy = float(m[0, 0]), m[1:-1, 0], float(m[-1, 0])
        self.xty, self.yty = m[1:-1, 1], float(m[-1, 1])

    def xtx(self, w: np.ndarray, centre: bool) -> np.ndarray:
        """X'X w, of the mean-centred X if ``centre``."""
        out = self.product(np.vstack([np.zeros((1, w.shape[1])), w, np.zeros((1, w.shape[1]))]))[1:-1]
        return out - np.outer(self.sx, self.sx @ w) / self.n if centre else out

    def rhs(self, centre: bool) -> np.ndarray:
        return self.xty - self.sx * self.sy / self.n if centre else self.xty


class PairGram(_Products):
    """Non-zero entries of Z'Z on the driver."""

    def __init__(self, i: np.ndarray, j: np.ndarray, v: np.ndarray, p: int):
        self.i, self.j, self.v, self.p = i, j, v, p
        self.off = i != j
        self.diag = np.bincount(i[~self.off], v[~self.off], p + 2)[1:-1]
        self.moments()

    def product(self, v: np.ndarray) -> np.ndarray:
        out = np.empty_like(v)
        o = self.off
        for k in range(v.shape[1]):
            out[:, k] = np.bincount(self.i, self.v * v[self.j, k], self.p + 2) + np.bincount(self.j[o], self.v[o] * v[self.i[o], k], self.p + 2)
        return out


class RowGram(_Products):
    """One pass over the stored rows for each product; tasks hold vectors only."""

    def __init__(self, df: DataFrame, p: int):
        self.rows, self.p = _source(df), p
        self.moments()
        squares = self.rows.select(F.explode(F.arrays_zip("at", "v")).alias("x")).groupBy("x.at").agg(F.sum(F.col("x.v") * F.col("x.v")).alias("d"))
        found = squares.toArrow()                                  # at most p rows
        self.diag = np.zeros(p)
        self.diag[found["at"].to_numpy()] = found["d"].to_numpy()

    def product(self, v: np.ndarray) -> np.ndarray:
        p, width = self.p, v.shape[1]

        def run(batches):
            out = np.zeros((p + 2, width))
            for batch in batches:
                ptr, places, values = _augmented(batch, p)
                row = np.repeat(np.arange(batch.num_rows), np.diff(ptr))
                for k in range(width):
                    t = np.bincount(row, values * v[places, k], batch.num_rows)
                    out[:, k] += np.bincount(places, values * t[row], p + 2)
            i, k = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(k, pa.int32()), pa.array(out[i, k])], names=["i", "k", "v"])

        got = self.rows.mapInArrow(run, "i int, k int, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros((p + 2, width))
        out[got["i"].to_numpy(), got["k"].to_numpy()] = got["v"].to_numpy()
        return out


def statistics(df: DataFrame, p: int, max_pairs: int = 20_000_000) -> _Products:
    """``PairGram`` where the design's non-zero pairs number at most ``max_pairs`` (the
    driver holds 16 bytes for each), else ``RowGram``; both give the same products."""
    pairs = materialize(pair_gram(df, p), "pairs")
    if pairs.count() > max_pairs:
        return RowGram(df, p)
    t = pairs.select("i", "j", "v").toArrow()
    return PairGram(t["i"].to_numpy(), t["j"].to_numpy(), t["v"].to_numpy(), p)


# ------------------------------------------------------------ solvers


def _fits(name: str, g: _Products, w: np.ndarray, params: list[dict], its: int, centre: bool, seconds: float) -> list[LinearFit]:
    return [LinearFit(name, w[:, k], float((g.sy - g.sx @ w[:, k]) / g.n) if centre else 0.0, dict(q), its, seconds / len(params)) for k, q in enumerate(params)]


def ridge_cg(g: _Products, alphas: Sequence[float], intercept: bool = False, eps: float = 1e-8, tol: float = 1e-12,
             max_iter: int = 2_000) -> list[LinearFit]:
    """(X'X + (alpha + eps) I)^-1 X'y for every alpha, by conjugate gradients with diagonal
    scaling, all alphas in the same products; ``intercept`` centres X and y. Stops when the
    residual has fallen to ``tol`` of its start."""
    t = time.time()
    lam = np.asarray(alphas, float) + (0.0 if intercept else eps)
    b = np.repeat(g.rhs(intercept)[:, None], len(lam), axis=1)
    diag = g.diag - g.sx**2 / g.n if intercept else g.diag
    scale = 1.0 / np.maximum(diag[:, None] + lam, 1e-30)
    w, r = np.zeros_like(b), b.copy()
    z = scale * r
    d, rz = z.copy(), (r * z).sum(axis=0)
    goal = tol * np.sqrt((b * b).sum(axis=0))
    its = 0
    while its < max_iter and (np.sqrt((r * r).sum(axis=0)) > goal).any():
        its += 1
        q = g.xtx(d, intercept) + lam * d
        curve = (d * q).sum(axis=0)
        step = np.divide(rz, curve, out=np.zeros_like(rz), where=curve > 0)
        w += step * d
        r -= step * q
        z = scale * r
        rz, before = (r * z).sum(axis=0), rz
        d = z + np.divide(rz, before, out=np.zeros_like(rz), where=before > 0) * d
    return _fits("Ridge", g, w, [{"alpha": float(a)} for a in alphas], its, intercept, time.time() - t)


def proximal(g: _Products, points: Sequence[tuple[float, float]], intercept: bool = False, tol: float = 1e-9,
             max_iter: int = 20_000) -> tuple[np.ndarray, int]:
    """Minima of 1/(2n)||y - Xw||^2 + l1 |w|_1 + l2/2 |w|^2 for every (l1, l2), by
    accelerated proximal gradients in the coordinates scaled by the diagonal of X'X;
    restarts where the momentum points uphill. Stops when no weight moves by ``tol`` of the
    largest one."""
    l1, l2 = (np.array(x, float) for x in zip(*points))
    diag = np.maximum((g.diag - g.sx**2 / g.n if intercept else g.diag) / g.n, 0.0)[:, None]
    on = diag > 1e-14                                              # a constant column keeps weight 0
    size = np.where(on, diag + l2, 1.0)
    b = (g.rhs(intercept) / g.n)[:, None]
    grad = lambda w: g.xtx(w, intercept) / g.n - b + l2 * w
    u = np.ones((len(diag), len(points)))                          # largest curvature after scaling
    for _ in range(30):
        s = u / np.sqrt(size)
        h = (g.xtx(s, intercept) / g.n + l2 * s) / np.sqrt(size)
        top = np.sqrt((h * h).sum(axis=0))
        u = h / np.maximum(top, 1e-300)
    step = on / (size * np.maximum(1.05 * top, 1e-300))
    w = np.zeros((len(diag), len(points)))
    v, momentum, its = w.copy(), np.ones(len(points)), 0
    for its in range(1, max_iter + 1):
        a = v - step * grad(v)
        new = np.sign(a) * np.maximum(np.abs(a) - step * l1, 0.0)
        new = np.where(on, new, 0.0)
        uphill = ((v - new) * (new - w) / np.where(on, step, 1.0)).sum(axis=0) > 0
        momentum = np.where(uphill, 1.0, momentum)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new + (momentum - 1) / after * (new - w)
        moved = np.abs(new - w).max(initial=0.0)
        w, momentum = new, after
        if moved <= tol * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w, its


def lasso_path(g: _Products, alphas: Sequence[float], intercept: bool = False, **more) -> list[LinearFit]:
    t = time.time()
    w, its = proximal(g, [(a, 0.0) for a in alphas], intercept, **more)
    return _fits("Lasso", g, w, [{"alpha": float(a)} for a in alphas], its, intercept, time.time() - t)


def elastic_net_path(g: _Products, points: Sequence[tuple[float, float]], intercept: bool = False, **more) -> list[LinearFit]:
    """points: (alpha, l1_ratio)."""
    t = time.time()
    w, its = proximal(g, [(a * r, a * (1 - r)) for a, r in points], intercept, **more)
    return _fits("ElasticNet", g, w, [{"alpha": float(a), "l1_ratio": float(r)} for a, r in points], its, intercept, time.time() - t)


# ------------------------------------------------------------ scores


def score_sparse(df: DataFrame, fits: Sequence[LinearFit]) -> DataFrame:
    """(model, n, rmse, mae, r2) of many fits over sparse rows in one pass."""
    w = np.column_stack([f.weights for f in fits]).astype(float)
    bias = np.array([f.bias for f in fits], float)

    def run(batches):
        n = sy = syy = 0.0
        sse, sae = np.zeros(len(bias)), np.zeros(len(bias))
        for batch in batches:
            ptr, places, values = _augmented(batch, len(w))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ptr))
            inner = (places > 0) & (places <= len(w))
            y = np.asarray(batch.column("y"), dtype=float)
            for k in range(len(bias)):
                e = y - bias[k] - np.bincount(row[inner], values[inner] * w[places[inner] - 1, k], batch.num_rows)
                sse[k] += e @ e
                sae[k] += np.abs(e).sum()
            n, sy, syy = n + len(y), sy + y.sum(), syy + y @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(bias), dtype=np.int32)), *(pa.array(np.full(len(bias), s)) for s in (n, sy, syy)), pa.array(sse), pa.array(sae)],
            names=["i", "n", "sy", "syy", "sse", "sae"])

    sums = _source(df).mapInArrow(run, "i int, n double, sy double, syy double, sse double, sae double")
    total = sums.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "sy", "syy", "sse", "sae")])
    names = df.sparkSession.createDataFrame([(i, f.name) for i, f in enumerate(fits)], "i int, model string")
    spread = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return total.join(F.broadcast(names), "i").select(
        "model", F.col("n").cast("long").alias("n"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), (F.col("sae") / F.col("n")).alias("mae"),
        F.when(spread > 0, 1.0 - F.col("sse") / spread).otherwise(F.lit(float("nan"))).alias("r2"))
