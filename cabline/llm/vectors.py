"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside them.

Centroids are fitted on a bounded sample; every vector then has its nearest cell as *home*
and is also copied to each other cell c whose centroid is nearly as near:

    y.home - y.c <= spill * |home - c| * sqrt(2 - 2 * threshold) / 2

With spill = 1 no pair at the threshold is lost: for x at home in c and y at home in c',
the two gaps y.c' - y.c and x.c - x.c' add up to at most |x - y| |c - c'|, so one of the
vectors is in the other's home cell. Inside a cell, home vectors are multiplied with all
vectors there, block by block, so a cell of any size spreads over tasks. A link counts for a
vector in its own home cell, or in the other's where the other is not copied to it; tiles
give counts and a spanning set of links, never all pairs. Equal vectors form one class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C
from cabline.session import drop_path, materialize_at


@dataclass(frozen=True)
class VectorParams:
    """threshold: cosine of a link. spill: share of the margin that loses nothing (1 is
    exact). cells: cells per square root of the number of vectors. sample: vectors that the centroids are fitted on, at most about so many.
    max_cells: bound of the number of cells. block: vectors on a side of a product."""

    threshold: float = 0.95
    spill: float = 1.0
    cells: float = 0.5
    sample: int = 50_000
    max_cells: int = 8_192
    rounds: int = 6
    block: int = 2_048
    seed: int = 5


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and offsets of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.values), np.asarray(column.offsets, np.int64)


def _bytes(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and offsets of a column of packed vectors (null: none)."""
    parts = [x or b"" for x in column.to_pylist()]
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), np.concatenate([[0], np.cumsum([len(x) // size for x in parts])]).astype(np.int64)


def _unit(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Vectors flat[off[r]: off[r + 1]] as unit rows in double precision, short ones padded."""
    flat = flat.astype(np.float64)
    size = np.diff(off)
    out = np.zeros((len(size), int(size.max(initial=1))))
    for n in np.unique(size):                      # almost always one length
        r = np.flatnonzero(size == n)
        out[r, :n] = flat[off[r][:, None] + np.arange(n)[None, :]]
    peak = np.abs(out).max(axis=1, keepdims=True)  # first, so that squares stay finite
    out /= np.where(peak > 0, peak, 1)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    return x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def fit_cells(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Unit centroids of spherical k-means; an emptied cell starts anew from a sample row."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[i: i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        lost = np.flatnonzero(norm[:, 0] < 1e-12)
        c = total / np.where(norm > 0, norm, 1)
        if len(lost):
            c[lost] = x[rng.choice(len(x), len(lost))]
    return c


def _assign(centroids: np.ndarray, p: VectorParams, kind: str):
    width = centroids.shape[1]
    apart = np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T)) if len(centroids) <= 2048 else None
    reach = p.spill * 0.5 * np.sqrt(2 - 2 * p.threshold) * (1 + 1e-9) + 1e-12

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                flat, off = _lists(part.column("vec"))
                x = _padded(_unit(flat, off), width)
                packed = flat.astype(kind).tobytes()
                size = np.dtype(kind).itemsize
                dots = x @ centroids.T
                home = dots.argmax(axis=1)
                gap = dots[np.arange(len(x)), home][:, None] - dots
                far = apart[home] if apart is not None else np.sqrt(np.maximum(0, 2 - 2 * centroids[home] @ centroids.T))
                near = gap <= reach * far
                near[np.arange(len(x)), home] = True
                r, c = np.nonzero(near)
                cells = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(len(x) + 1)).astype(np.int32)), pa.array(c.astype(np.int32)))
                packs = c.astype(np.int32).tobytes()
                cut = np.asarray(cells.offsets)
                own = pa.array([packs[4 * a: 4 * b] for a, b in zip(cut[:-1], cut[1:])], pa.binary())
                vec = pa.array([packed[size * a: size * b] for a, b in zip(off[:-1], off[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), part.column("weight"), pa.array(home.astype(np.int32)), cells, own, vec],
                    names=["rid", "weight", "home", "cells", "packed", "vec"])

    return run


def _compare(p: VectorParams, kind: str):
    def run(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.argsort(t["rid"].to_numpy(), kind="stable")))
        cell, i, j = (t[c][0].as_py() for c in ("cell", "i", "j"))
        rid, weight, home, hblock, block = (t[c].to_numpy() for c in ("rid", "weight", "home", "hblock", "block"))
        flat, off = _bytes(t["vec"], kind)
        x, dim = _unit(flat, off), np.diff(off)
        flat, off = _bytes(t["cells"], np.int32)
        h = np.flatnonzero((home == cell) & (hblock == i))
        a = np.flatnonzero(block == j)
        links = np.zeros(len(rid), np.int64)
        left, right = [], []
        # which of the home cells seen here the home vectors are copied to
        names, code = np.unique(home, return_inverse=True)
        owner = np.repeat(np.arange(len(rid)), np.diff(off))
        place = np.searchsorted(names, flat)
        ok = (place < len(names)) & (names[np.minimum(place, len(names) - 1)] == flat)
        copied = np.zeros((len(rid), len(names)), bool)
        copied[owner[ok], place[ok]] = True
        for s in range(0, len(h), 512):
            hs = h[s: s + 512]
            cos = x[hs] @ x[a].T
            r, c = np.nonzero(cos >= p.threshold)
            u, v = hs[r], a[c]
            keep = (u != v) & (dim[u] == dim[v])
            u, v = u[keep], v[keep]
            np.add.at(links, u, weight[v])
            back = (home[v] != cell) & ~copied[u, code[v]]
            np.add.at(links, v[back], weight[u[back]])
            root = C.local_roots(len(rid), u, v)       # a spanning set instead of all pairs
            at = np.flatnonzero(root != np.arange(len(rid)))
            left.append(at), right.append(root[at])
        root = C.local_roots(len(rid), np.concatenate(left), np.concatenate(right)) if left else np.arange(len(rid))
        keep = (links > 0) | (root != np.arange(len(rid)))
        return pa.table({"rid": rid[keep], "links": links[keep], "root": rid[root[keep]]})

    return run


def vector_links(vectors: DataFrame, column: str, params: VectorParams | None = None, keep: list[str] | None = None) -> DataFrame:
    """Near-duplicate classes of the vectors in ``column``.

    Returns every row (columns ``keep``, all by default) in a struct ``row`` with rid,
    n_links (other rows at or above the threshold) and class_rid (smallest rid that links
    reach). Null, empty and zero vectors and vectors with null or non-finite components link
    with nothing; vectors of different lengths never link; repeated rows are copies of each
    other. A vector's other columns, long texts among them, travel in ``row`` whatever their
    names. An empty table gives an empty result.
    """
    p = params or VectorParams()
    spark = vectors.sparkSession
    cols = vectors.columns if keep is None else list(dict.fromkeys([*keep, column]))
    base, _ = C.keyed(vectors.select(*[vectors[f"`{c}`"] for c in cols]), "vectors")
    single = base.schema["row"].dataType[column].dataType.simpleString() == "array<float>"
    kind, number = ("float32", "float") if single else ("float64", "double")
    v = F.col("row").getField(column).cast(f"array<{number}>")
    odd = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = base.select("rid", v.alias("v")).where(F.col("v").isNotNull()).where(~odd).where(F.exists("v", lambda e: e != 0))
    good = good.select("rid", F.transform("v", lambda e: F.when(e == 0, F.lit(0).cast(number)).otherwise(e)).alias("vec"))
    # equal vectors form a class, counted before any shuffle
    reps, reps_path = materialize_at(good.groupBy("vec").agg(F.min("rid").alias("rid"), F.count("*").alias("weight")), "vector-reps")
    n = reps.count()
    if not n:
        return base.withColumns({"n_links": F.lit(0).cast("long"), "class_rid": F.col("rid")})
    k = max(1, min(p.max_cells, round(p.cells * n**0.5)))
    share = min(1.0, p.sample / n)
    sample = reps.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < round(share * (1 << 30))).orderBy("rid").select("vec").toArrow()
    x = _unit(*_lists(sample["vec"])) if len(sample) else np.empty((0, 1))
    centroids = fit_cells(x, k, p.rounds, p.seed) if len(x) else np.ones((1, 1))
    placed, placed_path = materialize_at(
        reps.select("rid", "weight", "vec").mapInArrow(_assign(centroids, p, kind), "rid long, weight long, home int, cells array<int>, packed binary, vec binary"),
        "vector-cells")
    spread = placed.withColumn("cell", F.explode("cells"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / p.block)).cast("int")
    sizes = spread.groupBy("cell").agg(blocks(F.count_if(F.col("home") == F.col("cell"))).alias("rows"), blocks(F.count("*")).alias("cols"))
    # tiles (block of home vectors, block of all vectors): home vectors along a row of tiles,
    # all vectors down a column
    part = lambda n: F.pmod(F.xxhash64("rid"), n).cast("int")
    rows = spread.join(sizes, "cell").withColumns({"hblock": part(F.col("rows")), "block": part(F.col("cols"))})
    down = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda b: F.struct(b.alias("i"), F.col("block").alias("j")))
    along = F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda b: F.struct(F.col("hblock").alias("i"), b.alias("j")))
    tiles = F.when(F.col("home") == F.col("cell"), F.array_union(down, along)).otherwise(down)
    # where a vector is copied to is asked of home vectors only
    rows = rows.withColumn("tile", F.explode(tiles)).select(
        "cell", F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), "hblock", "block", "rid", "weight", "home",
        F.when(F.col("home") == F.col("cell"), F.col("packed")).alias("cells"), "vec")
    found, found_path = materialize_at(
        rows.groupBy("cell", "i", "j").applyInArrow(_compare(p, kind), "rid long, links long, root long"), "vector-links")
    final, final_paths = C.components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    near = found.groupBy("rid").agg(F.sum("links").alias("links"))
    head = (
        reps.join(near, "rid", "left").join(final.withColumnRenamed("node", "rid"), "rid", "left")
        .select("vec", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rid").alias("class_rid")))
    rows = good.join(head, "vec").select("rid", "n_links", "class_rid")
    rows, _ = materialize_at(rows, "vector-rows")
    for path in (reps_path, placed_path, found_path, *final_paths):
        drop_path(spark, path)
    return base.join(rows, "rid", "left").withColumns({
        "n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "class_rid": F.coalesce("class_rid", "rid")})


def drop_near_vectors(vectors: DataFrame, column: str, params: VectorParams | None = None) -> DataFrame:
    """``vectors`` with one row of each class (the first row number)."""
    out = vector_links(vectors, column, params).where("rid = class_rid")
    return out.select(*C.unkeyed(out, vectors.columns))
