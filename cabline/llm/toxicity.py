"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

A text's features are the character n-grams present in it (A-Z lowered), hashed into
buckets. A feature counts with its log-count ratio r = log(p / q), p and q being its shares
among toxic and other training texts, and a logistic regression is fitted on the scaled
features. Labels decide only which texts are learned from; the score uses nothing but text.

Training reads a bounded sample of labelled rows (``sample`` per class, drawn by a hash of
the id); scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C


@dataclass(frozen=True)
class ToxicityParams:
    """sizes: n-gram lengths. bits: log2 of the number of buckets. sample: labelled texts of
    each class that the fit may read. features: buckets with the strongest evidence that the
    model keeps. l2: penalty on the scaled weights. rounds: gradient steps of the fit. tasks: tasks that count the
    sample's features; each sends one dense array, so the sum's size does not depend on the
    cluster's partitions."""

    sizes: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 22
    sample: int = 8_192
    features: int = 2_048
    l2: float = 1e-3
    rounds: int = 300
    chunk: int = 1 << 18
    tasks: int = 8
    seed: int = 11


@dataclass(frozen=True)
class ToxicityModel:
    """buckets: kept features (ascending); weight: scaled weight of each; bias."""

    buckets: np.ndarray
    weight: np.ndarray
    bias: float
    sizes: tuple[int, ...]
    bits: int


def gram_buckets(raw: np.ndarray, off: np.ndarray, sizes: tuple[int, ...], bits: int):
    """For each n-gram length: (buckets by position, n), and the rows' character offsets."""
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    head = (raw & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(head)])[off]
    code = np.frombuffer(raw.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(code) != chars[-1]:                      # broken UTF-8: bytes stand for characters
        code, chars = raw.astype(np.uint32), off
    code = code.astype(np.uint64) + np.uint64(1)
    out, h = [], np.zeros(len(code), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(code) < n:
            break
        h = h[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:]
        if n in sizes:
            x = h ^ (h >> np.uint64(29))
            out.append((((x * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)) >> np.uint64(64 - bits)).astype(np.int64), n))
    return out, chars


def _present(raw, off, p, wanted: np.ndarray | None = None):
    """Distinct (row, bucket) pairs of texts; only buckets marked in ``wanted`` if given."""
    grams, chars = gram_buckets(raw, off, p.sizes, p.bits)
    pairs = []
    for bucket, n in grams:
        at = np.flatnonzero(wanted[bucket]) if wanted is not None else np.arange(len(bucket))
        row = np.searchsorted(chars, at, side="right") - 1
        inside = at + n <= chars[row + 1]           # no n-gram across two texts
        pairs.append((row[inside] << p.bits) | bucket[at[inside]])
    both = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    return both >> p.bits, both & ((1 << p.bits) - 1)


def _text_slices(batch):
    raw, off = C.text_buffers(batch.column("text"))
    for a, b in C.slices(off, 1 << 20):
        yield a, b, raw[off[a]: off[b]], off[a: b + 1] - off[a]


def _counts(p: ToxicityParams):
    """Texts of each class that hold each bucket, as chunks of dense counts."""

    def run(batches):
        held = np.zeros((2, 1 << p.bits), np.int32)
        total = np.zeros(2, np.int64)
        for batch in batches:
            label = batch.column("toxic").to_numpy()
            for a, b, raw, off in _text_slices(batch):
                row, bucket = _present(raw, off, p)
                y = label[a:b][row]
                for c in (0, 1):
                    held[c] += np.bincount(bucket[y == c], minlength=1 << p.bits).astype(np.int32)
                total += np.bincount(label[a:b], minlength=2)
        if not total.sum():
            return
        for k in range(0, 1 << p.bits, p.chunk):
            part = held[:, k: k + p.chunk]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()), pa.array([int(total[0])], pa.int64()), pa.array([int(total[1])], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                names=["chunk", "n0", "n1", "held"])

    return run


def _strongest(p: ToxicityParams):
    """Of one chunk of buckets: the features with the strongest evidence (likelihood ratio)."""

    def run(t: pa.Table) -> pa.Table:
        held = np.zeros((2, p.chunk), np.int64)
        for x in t["held"].to_pylist():
            held += np.frombuffer(x, np.int32).reshape(2, -1)
        n = np.array([t["n0"].to_numpy().sum(), t["n1"].to_numpy().sum()], np.float64)[:, None]
        seen = held.sum(axis=0)
        rate = np.maximum(seen / n.sum(), 1e-12)
        g = np.zeros(p.chunk)
        for k, e in ((held, rate), (n - held, 1 - rate)):
            g += (k * np.log(np.where(k > 0, k, 1) / np.maximum(n * e, 1e-12)) * (k > 0)).sum(axis=0)
        g[seen == 0] = -1
        top = np.argsort(-g, kind="stable")[: p.features]
        top = top[g[top] > 0]
        share = (held + 1) / (n + 2)
        ratio = np.log(share[1] / share[0])
        return pa.table({"bucket": top + t["chunk"][0].as_py(), "evidence": g[top], "ratio": ratio[top]})

    return run


def _vectors(p: ToxicityParams, buckets: np.ndarray):
    wanted = np.zeros(1 << p.bits, bool)
    wanted[buckets] = True

    def run(batches):
        for batch in batches:
            for a, b, raw, off in _text_slices(batch):
                row, bucket = _present(raw, off, p, wanted)
                ptr = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(np.searchsorted(buckets, bucket).astype(np.int32)))],
                    names=["toxic", "x"])

    return run


def fit_logistic(row: np.ndarray, col: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int):
    """Weighted logistic regression on presence features times ``scale``, by Adam steps."""
    w, m, v = (np.zeros(len(scale) + 1) for _ in range(3))
    base = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    w[-1] = np.log(base / (1 - base))
    part = weight / weight.sum()
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[col] * scale[col], minlength=len(y)) + w[-1]
        e = part * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.append(np.bincount(col, e[row] * scale[col], minlength=len(scale)) + l2 * w[:-1], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1] * scale, float(w[-1])


def train_toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column, params: ToxicityParams | None = None) -> ToxicityModel:
    """Fit on documents (doc_id, text) whose label (doc_id, toxic 0 or 1) may be learned from.

    may_learn: condition over doc_id of ``labels``. Null labels and ids are left out; an id
    labelled twice counts as toxic if either says so. Without both classes the model is a
    constant. The driver holds the model and the sample's feature lists, both bounded.
    """
    p = params or ToxicityParams()
    known = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.xxhash64(F.lit(p.seed), "doc_id")
    picks = [known.where(F.col("toxic") == c).orderBy(draw, "doc_id").limit(p.sample) for c in (0, 1)]
    chosen = F.broadcast(picks[0].unionByName(picks[1]))          # at most 2 * sample ids
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("toxic", "text")
    top = (
        rows.coalesce(p.tasks).mapInArrow(_counts(p), "chunk long, n0 long, n1 long, held binary")
        .groupBy("chunk").applyInArrow(_strongest(p), "bucket long, evidence double, ratio double")
        .orderBy(F.desc("evidence"), "bucket").limit(p.features).toPandas().sort_values("bucket"))
    buckets, ratio = top["bucket"].to_numpy(np.int64), top["ratio"].to_numpy(float)
    data = rows.mapInArrow(_vectors(p, buckets), "toxic int, x array<int>").toArrow()
    y = data["toxic"].to_numpy().astype(float)
    if not len(buckets) or len(set(y)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), float(np.log(share / (1 - share))), p.sizes, p.bits)
    size = np.array([len(x) for x in data["x"]])
    col = np.concatenate([np.asarray(x.values, np.int64) for x in data["x"]])
    row = np.repeat(np.arange(len(y)), size)
    per = np.array([sizes.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])     # the sample keeps the classes' true weights
    weight, bias = fit_logistic(row, col, ratio, y, per[y.astype(int)], p.l2, p.rounds)
    return ToxicityModel(buckets, weight, bias, p.sizes, p.bits)


def _score(model: ToxicityModel):
    p = ToxicityParams(sizes=model.sizes, bits=model.bits)

    def run(batches):
        wanted = np.zeros(1 << p.bits, bool)
        wanted[model.buckets] = True
        for batch in batches:
            for a, b, raw, off in _text_slices(batch):
                row, bucket = _present(raw, off, p, wanted)
                w = model.weight[np.searchsorted(model.buckets, bucket)] if len(bucket) else np.empty(0)
                z = np.bincount(row, w, minlength=b - a) + model.bias
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["row", "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, columns: list[str] | None = None) -> DataFrame:
    """Struct ``row`` (``columns`` of ``docs``, all by default) with score, 0 to 1.

    A null text scores like an empty one: the constant of the model. Equal texts score
    equally; texts of any length are read whole; an empty table gives an empty result. The
    input's columns are inside ``row``, so none can clash with the score."""
    cols = docs.columns if columns is None else columns
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), "text")
    return slim.mapInArrow(_score(model), C.row_schema(slim, "score double"))
