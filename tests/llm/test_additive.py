"""The additive quality model: features and scores against plain versions, held-out labels."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabline.llm import additive as A
from cabline.llm import common as C
from .conftest import AWKWARD, words

BREAKS = " \t\n\v\f\r"


def plain_measures(text):
    """The features of one text by plain counting."""
    text = text or ""
    w = words(text)
    kind = {c: k for k, chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
                                            "#*$%&|<>=@^~_\\/{}[]+", "!?", ",;:", ".", BREAKS], 1) for c in chars}
    n = collections.Counter(kind.get(c, 0 if c < "\x80" else "far") for c in text)
    chars = max(1, sum(n.values()) - n[8])
    letters = max(1, n[1] + n[2] + n["far"])
    some = max(1, len(w))
    upper = [sum("A" <= c <= "Z" for c in x) for x in w]
    runs = [tuple(w[i: i + 3]) for i in range(len(w) - 2)] or ([tuple(w)] if w else [])
    lines = [x for x in text.split("\n") if x]
    per_line = [len(words(x)) for x in lines]
    mean = len(w) / max(1, len(lines))
    spread = math.sqrt(sum((x - mean) ** 2 for x in per_line) / max(1, len(lines)))
    share = lambda hits: sum(hits) / some
    return [
        math.log1p(len(w)), sum(map(len, w)) / some, share(len(x) > 12 for x in w), n[2] / letters, n[3] / chars, n[4] / chars,
        n[5] / chars, n[6] / chars, n[7] / chars, n[0] / chars, n["far"] / letters, n[8] / (chars + n[8]),
        share(u > 1 and 2 * u > len(x) for u, x in zip(upper, w)), share("A" <= x[0] <= "Z" for x in w), (len(w) - len(set(w))) / some,
        (len(runs) - len(set(runs))) / some, max(collections.Counter(w).values(), default=0) / some, mean, spread / max(1, mean),
        (len(lines) - len(set(lines))) / max(1, len(lines)), sum(x[-1] in "!?." for x in lines) / max(1, len(lines)),
        share(kind.get(x[-1]) in (4, 5) for x in w)]


TEXTS = [r[1] for r in AWKWARD] + ["SHOUT!! LOUD!!\nA a, b; c.\nA a, b; c.\n\n x ##", "a", "\n\n", "é É 日本! ü\tq 12,5 %"]


def test_measures_count_as_plain_code():
    raw, off = C.text_buffers(pa.array(TEXTS, pa.large_string()))
    got = A.measures(raw, off)
    want = np.array([plain_measures(t) for t in TEXTS])
    assert got.shape == want.shape == (len(TEXTS), len(A.FEATURES))
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_tree_finds_the_best_cut():
    rng = np.random.default_rng(0)
    for _ in range(20):
        g, h, n = rng.normal(size=12), rng.random(12) + 0.1, rng.integers(1, 9, 12)
        gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1)
        best = max(range(1, 12), key=lambda c: gain(0, c) + gain(c, 12) if n[:c].sum() >= 4 and n[c:].sum() >= 4 else -1)
        out = A.shallow_tree(g, h, n, leaves=2, least=4, l2=1.0)
        if gain(0, best) + gain(best, 12) > gain(0, 12) + 1e-9:
            assert np.allclose(out[:best], g[:best].sum() / (h[:best].sum() + 1)) and np.allclose(out[best:], g[best:].sum() / (h[best:].sum() + 1))


def test_quadrants_find_the_best_pair_of_cuts():
    rng = np.random.default_rng(1)
    g, h, n = rng.normal(size=(4, 5)), rng.random((4, 5)) + 0.1, np.ones((4, 5)) * 3
    gain = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    cells = lambda i, j: [(slice(None, i), slice(None, j)), (slice(None, i), slice(j, None)), (slice(i, None), slice(None, j)), (slice(i, None), slice(j, None))]
    want = max(sum(map(gain, cells(i, j))) for i in range(1, 4) for j in range(1, 5)) - gain((slice(None), slice(None)))
    value, out = A.quadrants(g, h, n, 3, 1.0)
    assert value == pytest.approx(want) and len(np.unique(out)) == 4


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(2)
    x = rng.random((4_000, len(A.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = A.fit_additive(x[:3_000], y[:3_000], A.AdditiveParams(cycles=10, pairs=2))
    assert (3, 7) == model.pairs[0][:2]
    assert ((A.log_odds(model, x[3_000:]) > 0) == (y[3_000:] == 1)).mean() > 0.9
    plain = [model.base + sum(t[sum(v > e for e in edges)] for v, edges, t in zip(r, model.edges, model.tables))
             + sum(t[sum(r[f] > e for e in ef)][sum(r[k] > e for e in ek)] for f, k, ef, ek, t in model.pairs) for r in x[:50]]
    np.testing.assert_allclose(A.log_odds(model, x[:50]), plain)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = A.train_quality(docs, labels, ~held)
    again = A.train_quality(docs.repartition(5), labels.repartition(3), ~held)
    assert all(np.array_equal(a, b) for a, b in zip(model.tables, again.tables))
    rows = A.score_quality(docs, model, ["doc_id"]).select("row.doc_id", "score").join(labels, "doc_id").collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(rows) > 60 and sum((r["score"] >= 0.7) == r["quality"] for r in rows) / len(rows) > 0.95


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (8, 0), (9, 0), (None, 1), (10, None)], "doc_id long, quality int")
    model = A.train_quality(awkward, labels, F.lit(True), A.AdditiveParams(cycles=2, least=1))
    rows = A.score_quality(awkward, model).select("row.*", F.col("score").alias("scored")).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["scored"] <= 1 and r["score"] == "mine" for r in rows)
    by = collections.defaultdict(set)
    for r in rows:
        by[r["text"] or ""].add(r["scored"])
    assert all(len(v) == 1 for v in by.values())
    none = A.train_quality(awkward, labels.where("false"), F.lit(True))
    assert none.base == 0.0 and {r["score"] for r in A.score_quality(awkward, none).select("score").collect()} == {0.5}
    assert A.score_quality(awkward.where("false"), model).count() == 0
