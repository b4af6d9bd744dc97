"""Quality classifier: a generalised additive model with pairwise interactions.

A text has some 20 numeric features (shares of kinds of characters, word lengths, repeated
words and lines, line lengths). Each is cut into quantile bins, and the model is one lookup
table per feature and one per chosen pair of features, added up to a log-odds. Boosting goes
round the features in cycles: each turn fits a shallow tree on one feature's bins to the
current residuals and adds it to that feature's table, so that correlated features share
what they explain. Pairs are ranked by how much of the residuals a cut in both features
explains, and the best are boosted in cycles of their own. Scoring adds table entries of
whole batches.

The fit reads a bounded sample of labelled rows; every text is measured and scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C


@dataclass(frozen=True)
class AdditiveParams:
    """sample: labelled texts that the fit may read, drawn by a hash of the id. bins,
    pair_bins: quantile bins of a feature in its own table and in pairs. cycles, pair_cycles:
    boosting rounds over all features and pairs. pairs: interactions kept. leaves: leaves of
    the trees of single features. rate: share of a tree that is added. least: rows that a
    leaf needs. l2: added to a leaf's weight, so that small leaves stay near zero."""

    sample: int = 50_000
    bins: int = 64
    pair_bins: int = 8
    cycles: int = 120
    pair_cycles: int = 40
    pairs: int = 8
    leaves: int = 3
    rate: float = 0.15
    least: int = 8
    l2: float = 1.0
    seed: int = 13


@dataclass(frozen=True)
class AdditiveModel:
    """edges[f]: upper bounds of feature f's bins; tables[f]: log-odds by bin. pairs: (f, g,
    edges of f, edges of g, table). base: log-odds of the training share."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]
    base: float


# --- features ------------------------------------------------------------------------------

FEATURES = (
    "log_words", "word_length", "long_words", "upper", "digits", "symbols", "marks", "commas", "stops", "other_ascii",
    "non_ascii", "blanks", "shouted", "capital_words", "repeated_words", "repeated_runs", "top_word", "line_words",
    "line_spread", "repeated_lines", "lines_ended", "odd_ends",
)

_CLASS = np.zeros(256, np.int8)                   # 0 other, 1 lower, 2 upper, 3 digit, 4 symbol, 5 bang, 6 comma, 7 stop, 8 blank
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[list(b"#*$%&|<>=@^~_\\/{}[]+")] = 4
_CLASS[list(b"!?")] = 5
_CLASS[list(b",;:")] = 6
_CLASS[list(b".")] = 7
_CLASS[list(C.WORD_BREAKS)] = 8


def _runs(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row: values that stood in it before, and the most frequent value's count."""
    order = np.lexsort([hashes, rows])
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    size = np.diff(np.append(np.flatnonzero(new), len(r)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[new], size)
    return np.bincount(r, ~new, minlength=n), most


def measures(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature matrix (rows, features) of UTF-8 texts; an empty text has zeros only."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    kind = _CLASS[raw]
    count = lambda at, of=None: np.bincount(of if of is not None else row[at], minlength=n).astype(float)
    head = (raw & 0xC0) != 0x80
    per = [count(head & (kind == k)) for k in range(9)]
    non_ascii = count(head & (raw >= 0x80))
    chars = np.maximum(1.0, count(head) - per[8])
    letters = np.maximum(1.0, per[1] + per[2] + non_ascii)
    starts, ends, hashes, at = C.tokens(raw, off)
    words = np.diff(at).astype(float)
    some = np.maximum(1.0, words)
    of = np.repeat(np.arange(n), np.diff(at))
    heads = np.concatenate([[0], np.cumsum(head)])
    length = heads[ends] - heads[starts]
    uppers = np.concatenate([[0], np.cumsum(kind == 2)])
    upper = uppers[ends] - uppers[starts]
    last, first = kind[ends - 1] if len(ends) else kind[:0], kind[starts] if len(starts) else kind[:0]
    again, most = _runs(of, hashes, n)
    grams, ptr = C.window_hashes(hashes, at, 3)
    run_again, _ = _runs(np.repeat(np.arange(n), np.diff(ptr)), grams, n)
    ls, le, lh, lat = C.tokens(raw, off, b"\n")
    lines = np.diff(lat).astype(float)
    lof = np.repeat(np.arange(n), np.diff(lat))
    line_words = np.searchsorted(starts, le) - np.searchsorted(starts, ls)
    mean = words / np.maximum(1.0, lines)
    spread = np.sqrt(np.bincount(lof, (line_words - mean[lof]) ** 2, minlength=n) / np.maximum(1.0, lines))
    line_again, _ = _runs(lof, lh, n)
    ended = np.isin(kind[le - 1], (5, 7)) if len(le) else np.empty(0, bool)
    return np.stack([
        np.log1p(words), np.bincount(of, length, minlength=n) / some, count(None, of[length > 12]) / some,
        per[2] / letters, per[3] / chars, per[4] / chars, per[5] / chars, per[6] / chars, per[7] / chars, per[0] / chars - non_ascii / chars,
        non_ascii / letters, per[8] / (chars + per[8]), count(None, of[(upper > 1) & (2 * upper > length)]) / some,
        count(None, of[first == 2]) / some, again / some, run_again / some, np.where(words > 0, most / some, 0.0), mean,
        spread / np.maximum(1.0, mean), line_again / np.maximum(1.0, lines), np.bincount(lof, ended, minlength=n) / np.maximum(1.0, lines),
        count(None, of[(last == 4) | (last == 5)]) / some], axis=1)


def _measured(batch: pa.RecordBatch):
    """(first row, end row, features) of slices of bounded size; a longer text alone."""
    raw, off = C.text_buffers(batch.column("text"))
    for a, b in C.slices(off):
        yield a, b, measures(raw[off[a]: off[b]], off[a: b + 1] - off[a])


# --- fit -----------------------------------------------------------------------------------


def quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bounds of at most ``bins`` bins; a bin holds values above the bound below it up
    to its own. Equal quantiles give fewer bins."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower"))


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, x, side="left")


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int, least: int, l2: float) -> np.ndarray:
    """Leaf value of each bin: a tree that cuts the ordered bins into at most ``leaves`` runs,
    each cut the one that lowers the loss most. g, h, n: residuals, weights, rows by bin."""
    gain = lambda a, b: a * a / (b + l2)
    cg, ch, cn = (np.concatenate([[0], np.cumsum(x)]) for x in (g, h, n))
    runs = [(0, len(g))]
    while len(runs) < leaves:
        best, found = 1e-9, None
        for i, (a, b) in enumerate(runs):
            cut = np.arange(a + 1, b)
            fits = cut[(cn[cut] - cn[a] >= least) & (cn[b] - cn[cut] >= least)]
            if not len(fits):
                continue
            value = gain(cg[fits] - cg[a], ch[fits] - ch[a]) + gain(cg[b] - cg[fits], ch[b] - ch[fits]) - gain(cg[b] - cg[a], ch[b] - ch[a])
            if value.max() > best:
                best, found = float(value.max()), (i, int(fits[value.argmax()]))
        if found is None:
            break
        (a, b), cut = runs[found[0]], found[1]
        runs[found[0]: found[0] + 1] = [(a, cut), (cut, b)]
    out = np.empty(len(g))
    for a, b in runs:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int, l2: float) -> tuple[float, np.ndarray]:
    """Best tree with one cut in each feature of a pair: (loss it saves, value by cell)."""
    sums = [np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h, n)]
    total = sums[0][-1, -1] ** 2 / (sums[1][-1, -1] + l2)
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def parts(s):
        low, left, up = s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j]
        return [low, left, up, s[-1, -1] - low - left - up]

    value = sum(a * a / (b + l2) for a, b in zip(parts(sums[0]), parts(sums[1]))) - total
    value = np.where(np.min(parts(sums[2]), axis=0) >= least, value, 0.0)
    if not value.size or value.max() <= 0:
        return 0.0, np.zeros(g.shape)
    a, b = (int(x) for x in np.unravel_index(value.argmax(), value.shape))
    leaf = [pg[a, b] / (ph[a, b] + l2) for pg, ph in zip(parts(sums[0]), parts(sums[1]))]
    out = np.empty(g.shape)
    out[: a + 1, : b + 1], out[: a + 1, b + 1:], out[a + 1:, : b + 1], out[a + 1:, b + 1:] = leaf
    return float(value.max()), out


def fit_additive(x: np.ndarray, y: np.ndarray, p: AdditiveParams) -> AdditiveModel:
    """Boosted tables on a feature matrix and 0/1 labels."""
    share = np.clip((y.sum() + 0.5) / (len(y) + 1), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    if not len(y) or len(set(y)) < 2:
        return AdditiveModel([np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [], base)
    edges = [quantile_edges(c, p.bins) for c in x.T]
    bins = [binned(c, e) for c, e in zip(x.T, edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    count = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    z = np.full(len(y), base)

    def residuals():
        odds = 1 / (1 + np.exp(-z))
        return y - odds, odds * (1 - odds)

    for _ in range(p.cycles):
        for f, (b, t) in enumerate(zip(bins, tables)):
            g, h = residuals()
            step = p.rate * shallow_tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), count[f], p.leaves, p.least, p.l2)
            t += step
            z += step[b]

    coarse = [quantile_edges(c, p.pair_bins) for c in x.T]
    grid = [binned(c, e) for c, e in zip(x.T, coarse)]

    def sums(f, k, *values):
        shape = len(coarse[f]) + 1, len(coarse[k]) + 1
        cell = grid[f] * shape[1] + grid[k]
        return cell, [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in values]

    g, h = residuals()
    ones = np.ones(len(y))
    ranked = sorted(
        ((quadrants(*sums(f, k, g, h, ones)[1], p.least, p.l2)[0], -f, -k) for f in range(len(coarse)) for k in range(f + 1, len(coarse))),
        reverse=True)
    chosen = [(-f, -k) for value, f, k in ranked[: p.pairs] if value > 0]
    pair_tables = [np.zeros((len(coarse[f]) + 1, len(coarse[k]) + 1)) for f, k in chosen]
    for _ in range(p.pair_cycles):
        for (f, k), t in zip(chosen, pair_tables):
            g, h = residuals()
            cell, by = sums(f, k, g, h, ones)
            step = p.rate * quadrants(*by, p.least, p.l2)[1]
            t += step
            z += step.ravel()[cell]
    return AdditiveModel(edges, tables, [(f, k, coarse[f], coarse[k], t) for (f, k), t in zip(chosen, pair_tables)], base)


def log_odds(model: AdditiveModel, x: np.ndarray) -> np.ndarray:
    """Sum of the table entries of every row's bins."""
    z = np.full(len(x), model.base)
    for c, edges, table in zip(x.T, model.edges, model.tables):
        z += table[binned(c, edges)]
    for f, k, ef, ek, table in model.pairs:
        z += table[binned(x[:, f], ef), binned(x[:, k], ek)]
    return z


def train_quality(docs: DataFrame, labels: DataFrame, may_learn: Column, params: AdditiveParams | None = None) -> AdditiveModel:
    """Fit on documents (doc_id, text) whose label (doc_id, quality 0 or 1) may be learned from.

    may_learn: condition over doc_id of ``labels``. Null labels and ids are left out; an id
    labelled twice counts as bad if either says so, and of an id with several texts the
    least one is read. With one class only, or without labels, the model is a constant. The
    driver holds the sample's feature matrix (``sample`` rows of 22 numbers) and the tables.
    """
    p = params or AdditiveParams()
    known = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    chosen = F.broadcast(known.orderBy(F.xxhash64(F.lit(p.seed), "doc_id"), "doc_id").limit(p.sample))   # at most ``sample`` ids

    def run(batches):
        for batch in batches:
            for a, b, x in _measured(batch):
                values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a), values], names=["doc_id", "label", "x"])

    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", "text")
    data = rows.mapInArrow(run, "doc_id long, label int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("m"))
    data = data.select("doc_id", "m.label", "m.x").orderBy("doc_id").toArrow()
    x = np.asarray(data["x"].combine_chunks().flatten() if len(data) else [], float).reshape(len(data), len(FEATURES))
    return fit_additive(x, data["label"].to_numpy().astype(float), p)


def score_quality(docs: DataFrame, model: AdditiveModel, columns: list[str] | None = None) -> DataFrame:
    """Struct ``row`` (``columns`` of ``docs``, all by default) with score, 0 to 1.

    Nothing but the text is an input. A null text scores like an empty one; texts of any
    length are measured whole; equal texts score equally; an empty table gives an empty
    result. The input's columns are inside ``row``, so none can clash with the score."""
    cols = docs.columns if columns is None else columns
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), docs["text"])

    def run(batches):
        for batch in batches:
            for a, b, x in _measured(batch):
                score = 1 / (1 + np.exp(-np.clip(log_odds(model, x), -40, 40)))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), pa.array(score)], names=["row", "score"])

    return slim.mapInArrow(run, C.row_schema(slim, "score double"))
