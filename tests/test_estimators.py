"""Pipeline stages, mini-batch descent, library search and the boards against NumPy."""

import tempfile

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cabline.operators import estimators as ES
from cabline.operators import linear as LN
from cabline.plans import model as MJ


def _rows(n=900, seed=4):
    rs = np.random.RandomState(seed)
    x = np.column_stack([rs.randn(n), rs.randn(n) * 2, (rs.rand(n) < 0.3).astype(float)])
    y = x @ [3.0, -1.0, 2.0] + 5.0 + rs.randn(n)
    split = np.where(np.arange(n) % 10 < 6, "train", np.where(np.arange(n) % 10 < 8, "validation", "test"))
    return x, y, split


@pytest.fixture(scope="module")
def design(spark):
    x, y, split = _rows()
    rows = [(int(i), s, float(t), v.tolist()) for i, (s, t, v) in enumerate(zip(split, y, x))]
    df = spark.createDataFrame(rows, "id int, split string, y double, x array<double>")
    return df.select("split", "y", "x", F.timestamp_seconds(F.col("id") * 60).alias("pickup_datetime"))


def test_descent_comes_near_the_minimum_for_any_partitioning(design):
    x, y, split = _rows()
    runs = [MJ.run_of(design.repartition(k), 3) for k in (1, 7)]
    fits = [LN.minibatch_descent(r.batches, alpha=0.01) for r in runs]
    assert np.allclose(fits[0].weights, fits[1].weights, rtol=1e-9) and np.isclose(fits[0].bias, fits[1].bias)
    exact = LN.intercept_fit("SGD", runs[0].grams["train"], alpha=0.01)
    t = split == "train"

    def loss(f):
        e = y[t] - x[t] @ f.weights - f.bias
        return e @ e / t.sum() / 2 + 0.005 * f.weights @ f.weights

    assert loss(exact) <= loss(fits[0]) <= 1.01 * loss(exact)
    with pytest.raises(ValueError):
        LN.minibatch_descent(runs[0].batches, eta0=50.0)


def test_full_board_and_test_board_equal_numpy(spark, design):
    x, y, split = _rows()
    tr, va, te = (split == s for s in ("train", "validation", "test"))
    run = MJ.run_of(design, 3)
    board = {r["model"]: r for r in MJ.leaderboard(spark, run).collect()}
    assert len(board) == 10 and {r["type"] for r in board.values()} == {"From Scratch", "Library", "Baseline"}

    def scores(w, b, k):
        e = y[k] - x[k] @ w - b
        return np.sqrt(np.mean(e * e)), np.mean(np.abs(e)), 1 - e @ e / ((y[k] - y[k].mean()) ** 2).sum()

    def ridge(k, alpha, free):
        m, c = (x[k].mean(0), y[k].mean()) if free else (np.zeros(3), 0.0)
        w = np.linalg.solve((x[k] - m).T @ (x[k] - m) + (alpha + (0 if free else 1e-8)) * np.eye(3), (x[k] - m).T @ (y[k] - c))
        return w, c - m @ w

    for name, fit in (("Ridge (From Scratch)", ridge(tr, 1.0, False)), ("Ridge (Library)", ridge(tr, 1.0, True)),
                      ("Baseline (Mean)", (np.zeros(3), y[tr].mean())), ("Baseline (Median)", (np.zeros(3), np.median(y[tr])))):
        got = board[name]
        assert np.allclose((got["val_rmse"], got["val_mae"], got["val_r2"]), scores(*fit, va), atol=1e-9), name
        assert got["n_features"] == (0 if "Baseline" in name else 3)
    held, cv = MJ.grid_holdout(run), MJ.grid_cv(run)
    want = min(MJ.SCRATCH_GRID["Ridge"]["alpha"], key=lambda a: scores(*ridge(tr, a, False), va)[0])
    assert held["Ridge"]["params"] == {"alpha": want}
    tests = MJ.refit_test(spark, run, held, cv)
    both = {r["model"]: r for r in tests.collect()}
    got = both["Ridge (Intercept)"]
    assert np.allclose((got["test_rmse"], got["test_mae"], got["test_r2"]), scores(*ridge(tr | va, cv["Ridge"]["params"]["alpha"], True), te), atol=1e-9)
    rep = MJ.report(spark, run, tests).first()
    models = {m: r["test_rmse"] for m, r in both.items() if r["type"] != "Baseline"}
    assert rep["winner"] == min(models, key=models.get)
    assert np.isclose(rep["avg_rmse_scratch"], np.mean([r["test_rmse"] for r in both.values() if r["type"] == "From Scratch"]))
    assert np.isclose(rep["improvement_pct"], (both["Baseline (Mean)"]["test_rmse"] - min(models.values())) / both["Baseline (Mean)"]["test_rmse"] * 100)


def test_library_search_finds_the_winner_of_the_statistics(design):
    run = MJ.run_of(design, 3)
    grids = {"Ridge": {"alpha": [0.01, 10.0, 500.0]}, "ElasticNet": {"alpha": [0.01, 0.5], "l1_ratio": [0.2, 0.8]}}
    ours, theirs = MJ.grid_cv(run, grids=grids), MJ.grid_cv_library(run, grids)
    for name in grids:
        assert ours[name]["params"] == theirs[name]["params"]
        assert np.allclose([m for _, m in ours[name]["curve"]], [m for _, m in theirs[name]["curve"]], atol=2e-4)
        assert np.allclose(ours[name]["fit"].weights, theirs[name]["fit"].weights, atol=2e-3)


def test_stages_are_stored_and_read(spark):
    rows = [(float(i % 9), float(i % 4), ["x", "y", None][i % 3], i % 2, float(i % 9 * 2 + i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, c string, d int, y double")
    made = Pipeline(stages=[ES.Design(numeric=["a", "b"], categorical=["c"], binary=["d"], interaction=["a", "b"]),
                            ES.PenalisedRegression(kind="Ridge", alpha=0.5)]).fit(df)
    path = f"{tempfile.mkdtemp(prefix='cabline-stage-')}/model"
    made.write().overwrite().save(path)
    read = PipelineModel.load(path)
    later = spark.createDataFrame([(3.0, 1.0, "x", 1, None), (100.0, -5.0, "never seen", 0, None)], df.schema)
    a, b = (m.transform(df.unionByName(later)).select("x", "prediction").collect() for m in (made, read))
    assert a == b and len(a[0]["x"]) == 2 + 2 + 1 + 3
    assert read.stages[1].as_fit().params["alpha"] == 0.5
    lasso = ES.PenalisedRegression(kind="Lasso", alpha=0.1, predictionCol="guess")
    fit = lasso.fit(read.stages[0].transform(df))
    assert "guess" in fit.transform(read.stages[0].transform(df)).columns
    with pytest.raises(ValueError):
        lasso.fit(read.stages[0].transform(df.where("false")))


def test_prediction_is_compiled_or_one_product(spark):
    rng = np.random.default_rng(0)
    for p in (1, 5, 60, LN.UNROLLED + 1):
        x, w = rng.normal(size=(20, p)), rng.normal(size=p)
        w[0] = 0.0 if p > 1 else w[0]
        df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
        out = df.select("x", LN.predict(LN.LinearFit("m", w, 0.25)).alias("v"))
        assert all(np.isclose(r["v"], np.dot(r["x"], w) + 0.25) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in plan and ("ArrowEvalPython" in plan) == (p > LN.UNROLLED)
