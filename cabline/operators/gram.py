"""Sufficient statistics of least squares in one distributed pass.

Each partition adds up ``X'X``, ``X'y``, ``sum X``, ``sum y``, ``y'y`` and ``n`` over its
Arrow batches; Spark sums the partial entries by index (map-side combine),
and only the (p+2)^2-sized result reaches the driver. Every linear model here is
solved from these numbers, so one pass serves all models and all grid points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Gram:
    n: float
    sx: np.ndarray       # (p,)
    sy: float
    xtx: np.ndarray      # (p, p)
    xty: np.ndarray      # (p,)
    yty: float

    @staticmethod
    def empty(p: int) -> Gram:
        return Gram(0.0, np.zeros(p), 0.0, np.zeros((p, p)), np.zeros(p), 0.0)

    @property
    def p(self) -> int:
        return len(self.sx)

    def __add__(self, o: Gram) -> Gram:
        return Gram(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.xtx + o.xtx, self.xty + o.xty,
                    self.yty + o.yty)

    def __sub__(self, o: Gram) -> Gram:
        return Gram(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.xtx - o.xtx, self.xty - o.xty,
                    self.yty - o.yty)


def _partials(p: int):
    """Statistics per group over a whole partition, as the upper triangle of Z'Z for
    Z = [1, x, y]; one row set per group and partition leaves the task."""
    def run(batches):
        upper = np.triu_indices(p + 2)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.column("g").null_count:
                batch = batch.filter(batch.column("g").is_valid())
            if not batch.num_rows:
                continue
            x = batch.column("x")
            flat = np.asarray(x.flatten(), dtype=float).reshape(batch.num_rows, p)
            z = np.column_stack([np.ones(batch.num_rows), flat, np.asarray(batch.column("y"), dtype=float)])
            g = batch.column("g").dictionary_encode()
            codes = np.asarray(g.indices)
            for k, key in enumerate(g.dictionary.to_pylist()):
                part = z if len(g.dictionary) == 1 else z[codes == k]
                sums[key] = sums.get(key, 0.0) + part.T @ part
        for key, m in sums.items():
            v = m[upper]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(v), pa.string()), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=["g", "k", "v"])
    return run


def gram_by(df: DataFrame, p: int, group: str | None = None, x: str = "x", y: str = "y") -> DataFrame:
    """Long table (g, k, v) of summed statistics per group value (e.g. split or fold).
    Rows with a NULL group or target are left out."""
    gcol = F.col(group).cast("string") if group else F.lit("all")
    src = df.select(gcol.alias("g"), F.col(x).cast("array<double>").alias("x"), F.col(y).cast("double").alias("y"))
    # rows without a group are left out in the task: as a condition it would be pushed below
    # the group's expression, which may read the whole design, and compute both twice
    parts = src.where("y IS NOT NULL").mapInArrow(_partials(p), "g string, k int, v double")
    return parts.groupBy("g", "k").agg(F.sum("v").alias("v"))


def _unflatten(vals: np.ndarray, p: int) -> Gram:
    m = np.zeros((p + 2, p + 2))
    m[np.triu_indices(p + 2)] = vals
    m = m + np.triu(m, 1).T
    return Gram(float(m[0, 0]), m[0, 1:-1], float(m[0, -1]), m[1:-1, 1:-1], m[1:-1, -1], float(m[-1, -1]))


def collect_grams(df: DataFrame, p: int, group: str | None = None, x: str = "x", y: str = "y") -> dict[str, Gram]:
    """Gram statistics per group value; the driver receives (p+2)^2 numbers per group."""
    size = (p + 2) * (p + 3) // 2
    out: dict[str, np.ndarray] = {}
    for r in gram_by(df, p, group, x, y).collect():
        out.setdefault(r["g"], np.zeros(size))[r["k"]] = r["v"]
    return {g: _unflatten(v, p) for g, v in out.items()}
