"""Sparse designs against the dense one, and wide ones against block elimination."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabline.operators import features as FT
from cabline.operators import linear as LN
from cabline.operators import sparse as SP
from cabline.operators.gram import collect_grams
from cabline.session import materialize


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), ["x", "y", "z", None][c], int(d), float(2 * a - b + c + e), "train" if s < 7 else "test")
            for a, b, c, d, e, s in zip(rng.normal(size=600), rng.normal(size=600), rng.integers(0, 4, 600), rng.integers(0, 2, 600),
                                        rng.normal(size=600), rng.integers(0, 10, 600))]
    rows += [(0.0, 1.0, "unseen", 1, 5.0, "test"), (0.5, 1.0, "x", 1, None, "train")]
    return spark.createDataFrame(rows, "a double, b double, c string, d int, y double, split string").withColumn("const", F.lit(4.0))


SHAPE = dict(numeric=("a", "b", "const"), categorical=("c",), binary=("d",), interaction=("a", "b"))


@pytest.fixture(scope="module")
def designs(frame):
    train = frame.where("split = 'train'")
    dense, sparse = FT.Preprocessor(**SHAPE).fit(train), SP.SparsePreprocessor(**SHAPE).fit(train)
    keep = ["split", "y"]
    return dense, materialize(dense.transform(frame, keep), "dense"), sparse, materialize(sparse.transform(frame, keep), "sparse")


def test_same_columns_and_entries(spark, frame, designs):
    dense, _, sparse, _ = designs
    assert [r["name"] for r in sparse.names(spark).orderBy("place").collect()] == dense.feature_names()
    both = dense.transform(frame).collect(), sparse.transform(frame).collect()
    filled = sorted([float(dict(zip(r["at"], r["v"])).get(i, 0.0)) for i in range(sparse.width)] for r in both[1])
    assert np.allclose(filled, sorted(r["x"] for r in both[0]))
    assert all(r["at"] == sorted(r["at"]) and 0.0 not in r["v"] for r in both[1])


def test_pairs_and_passes_give_the_dense_gram(designs):
    dense, x, sparse, s = designs
    want = collect_grams(x, sparse.width, "split")
    full = np.zeros((2, sparse.width + 2, sparse.width + 2))
    for r in SP.pair_gram(s.repartition(5), sparse.width, "split").collect():
        full[["train", "test"].index(r["g"]), r["i"], r["j"]] = full[["train", "test"].index(r["g"]), r["j"], r["i"]] = r["v"]
    for m, g in zip(full, (want["train"], want["test"])):
        assert m[0, 0] == g.n and np.allclose(m[1:-1, 1:-1], g.xtx) and np.allclose(m[1:-1, -1], g.xty) and np.isclose(m[-1, -1], g.yty)
    v = np.random.default_rng(0).normal(size=(sparse.width + 2, 3))
    train = s.where("split = 'train'")
    a, b = SP.statistics(train, sparse.width), SP.statistics(train, sparse.width, max_pairs=0)
    assert isinstance(a, SP.PairGram) and isinstance(b, SP.RowGram)
    assert np.allclose(a.product(v), full[0] @ v) and np.allclose(b.product(v), full[0] @ v) and np.allclose(a.diag, b.diag)


@pytest.mark.parametrize("max_pairs", [10**6, 0])
def test_fits_equal_the_dense_ones(designs, max_pairs):
    _, x, sparse, s = designs
    g = collect_grams(x.where("split = 'train'"), sparse.width)["all"]
    st = SP.statistics(s.where("split = 'train'"), sparse.width, max_pairs)
    for fit, alpha in zip(SP.ridge_cg(st, [0.5, 10.0]), (0.5, 10.0)):
        assert np.allclose(fit.weights, LN.ridge(g, alpha).weights, atol=1e-8)
    if max_pairs:
        both = SP.ridge_cg(st, [2.0], intercept=True)[0], LN.intercept_fit("Ridge", g, alpha=2.0)
        assert np.allclose(both[0].weights, both[1].weights, atol=1e-8) and np.isclose(both[0].bias, both[1].bias)
        for fit, point in zip(SP.elastic_net_path(st, [(0.1, 0.5), (0.4, 0.2), (0.3, 1.0)]), [(0.05, 0.05), (0.08, 0.32), (0.3, 0.0)]):
            w, _ = LN.coordinate_descent(g, *point, max_iter=20_000, tol=1e-12)
            e = lambda w: (g.yty - 2 * w @ g.xty + w @ g.xtx @ w) / (2 * g.n) + point[0] * np.abs(w).sum() + point[1] / 2 * w @ w
            assert e(fit.weights) <= e(w) + 1e-9
        lasso = SP.lasso_path(st, [0.2], intercept=True)[0]
        want = LN.intercept_fit("Lasso", g, alpha=0.2, max_iter=20_000, tol=1e-12)
        assert np.isclose(lasso.bias, want.bias, atol=1e-5)


def test_scores_equal_the_dense_ones(designs):
    _, x, sparse, s = designs
    fits = [LN.LinearFit("one", np.linspace(-1, 1, sparse.width), 0.3), LN.LinearFit("two", np.ones(sparse.width), 0.0)]
    a = {r["model"]: r for r in LN.score_many(x, fits).collect()}
    b = {r["model"]: r for r in SP.score_sparse(s, fits).collect()}
    assert all(np.isclose(a[m][c], b[m][c]) for m in a for c in ("rmse", "mae", "r2"))


def test_fifty_thousand_categories(spark):
    """One numeric and 50,000 categories: the weights by eliminating the category block."""
    n, cats, alpha = 150_000, 50_000, 2.0
    df = spark.range(n).select(
        (F.col("id") % cats).cast("string").alias("c"), (F.rand(5) * 4).alias("a"),
        (F.col("id") % 7 + F.rand(6)).alias("e")).withColumn("y", F.col("a") * 3 + F.col("e"))
    df = materialize(df, "many")
    pre = SP.SparsePreprocessor(numeric=("a",), categorical=("c",), binary=(), interaction=None).fit(df)
    assert pre.width == cats + 1
    rows = materialize(pre.transform(df, ["y"]), "rows")
    fit = SP.ridge_cg(SP.statistics(rows, pre.width), [alpha], eps=0.0)[0]
    t = df.toPandas()
    x = (t["a"] - t["a"].mean()) / t["a"].std(ddof=0)
    s = t.assign(x=x).groupby("c").agg(n=("x", "size"), s=("x", "sum"), t=("y", "sum"))
    w = (x @ t["y"] - (s["s"] * s["t"] / (s["n"] + alpha)).sum()) / (x @ x + alpha - (s["s"] ** 2 / (s["n"] + alpha)).sum())
    assert np.isclose(fit.weights[0], w, rtol=1e-9)
    assert np.allclose(fit.weights[1:], ((s["t"] - s["s"] * w) / (s["n"] + alpha)).sort_index().to_numpy(), atol=1e-8)


def test_empty_training_set(spark, frame):
    none = frame.where("false")
    pre = SP.SparsePreprocessor(**SHAPE).fit(none)
    assert pre.width == 3 + 0 + 1 + 3 and pre.transform(none).count() == 0
