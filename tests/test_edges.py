"""Inline edge fixtures: ledger states, buckets, categories, design columns."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cabline import schemas
from cabline.operators import diagnose as DG
from cabline.operators import features as FT
from cabline.operators import profile
from cabline.sources import ledger as LG


def _ledger(spark):
    rows = [("yellow", 2024, 1, 100, "OK"), ("yellow", 2024, 2, 0, "ERROR"), ("yellow", 2024, 2, 90, "OK"),
            ("yellow", 2024, 3, 0, "ERROR"), ("green", 2024, 1, 10, "OK")]
    return spark.createDataFrame([(s, y, m, r, st, "t", None, None) for s, y, m, r, st in rows], schemas.LEDGER)


def test_ledger_states(spark):
    led = _ledger(spark)
    want = LG.month_grid(spark, ["yellow", "green"], [2024], [1, 2, 3, 4])
    pend = {tuple(r) for r in LG.pending_months(want, led).collect()}
    assert pend == {("yellow", 2024, 3), ("yellow", 2024, 4), ("green", 2024, 2), ("green", 2024, 3),
                    ("green", 2024, 4)}
    summ = {(r["service"], r["status"]): (r["n_months"], r["total_rows"]) for r in LG.ledger_summary(led).collect()}
    assert summ[("yellow", "OK")] == (2, 190) and summ[("yellow", "ERROR")] == (2, 0)
    rate = {r["service"]: r for r in LG.ledger_error_rate(led).collect()}
    assert rate["yellow"]["error_pct"] == 50.0 and rate["green"]["ERROR"] == 0 and rate["green"]["error_pct"] == 0.0


def test_price_and_decile_buckets(spark):
    vals = [0.0, 10.0, 10.0, 10.0, 20.0, 25.0, 30.0, 50.0, 100.0, 150.0] * 3
    df = spark.createDataFrame([(v, v / 10) for v in vals], "y double, e double")
    got = {r["bucket"]: r["count"] for r in DG.error_by_price_bucket(df).collect()}
    # (a, b] intervals: 0 falls outside, 10 in the first, 100 in the fifth
    assert got == {1: 9, 2: 3, 3: 6, 4: 3, 5: 3, 6: 3}
    dec = DG.error_by_quantile_bucket(df).collect()
    s = pd.Series(vals)
    ref = pd.qcut(s, q=10, duplicates="drop").value_counts(sort=False).tolist()
    assert [r["count"] for r in dec] == [c for c in ref if c > 0]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = profile.histogram(df, F.col("x"), 5).collect()
    counts, _ = np.histogram(np.arange(11), bins=5)
    assert [r["count"] for r in h] == counts.tolist()


def test_top_k_ties_unseen_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), (None,), (None,), (None,)], "z string")
    top = [r["z"] for r in FT.top_k_set(df, "z", 2).collect()]
    assert top == ["b", "c"]                       # NULL never counts; tie at rank 2 broken by value
    kept = {r["z"]: r["k"] for r in FT.keep_top_k(df, "z", 2, "k").distinct().collect()}
    assert kept == {"a": "Other", "b": "b", "c": "c", None: "Other"}
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    pre = FT.Preprocessor(numeric=(), categorical=["c"], binary=(), interaction=None).fit(train)
    rows = pre.transform(spark.createDataFrame([("y",), ("unseen",)], "c string")).collect()
    assert [r["x"] for r in rows] == [[0.0, 1.0], [0.0, 0.0]]


def test_constant_duplicate_zero_columns(spark):
    df = spark.createDataFrame([(5.0, float(i), float(i), 0.0) for i in range(6)], "k double, a double, b double, z double")
    pre = FT.Preprocessor(numeric=["k", "a", "b", "z"], categorical=(), binary=(), interaction=("a", "b")).fit(df)
    x = np.array([r["x"] for r in pre.transform(df).collect()])
    assert np.all(x[:, 0] == 0.0) and np.all(x[:, 3] == 0.0)         # constant / zero columns -> 0
    assert np.allclose(x[:, 1], x[:, 2]) and np.allclose(x[:, 4], x[:, 1])   # duplicated block
    assert abs(x[:, 1].std() - 1.0) < 1e-12                           # population std
    assert pre.feature_names()[-3:] == ["a", "b", "a b"]


def test_cardinality_exact_and_approx(spark):
    df = spark.createDataFrame([(i % 7, None if i % 5 == 0 else f"z{i % 11}") for i in range(500)], "a int, b string")
    exact = {r["column_name"]: r["n_unique"] for r in profile.cardinality(df, ["a", "b"]).collect()}
    approx = {r["column_name"]: r["n_unique"] for r in profile.cardinality(df, ["a", "b"], approx=True).collect()}
    assert exact == {"a": 7, "b": 11} and approx == exact     # NULL is not a value


def test_grouped_percentiles_match_pandas(spark):
    rng = np.random.RandomState(3)
    g = rng.randint(0, 4, 3000)
    v = np.where(g == 0, 1.5, rng.exponential(10, 3000))     # group 0 is one hot value
    df = spark.createDataFrame(pd.DataFrame({"g": g.astype(int), "v": v}))
    from cabline.operators.selection import exact_percentiles
    got = {r["g"]: r["q"] for r in exact_percentiles(df, "v", [0.1, 0.5, 0.99], ["g"]).collect()}
    ref = pd.DataFrame({"g": g, "v": v}).groupby("g")["v"].quantile([0.1, 0.5, 0.99]).unstack()
    for k, row in ref.iterrows():
        assert np.allclose(got[k], row.tolist(), atol=1e-9)


def test_quantile_buckets_of_constant_and_missing_actuals(spark):
    one = spark.createDataFrame([(5.0, 0.1), (5.0, 0.3)], "y double, e double")
    r = DG.error_by_quantile_bucket(one).collect()
    assert [(x["bucket"], x["lo"], x["hi"], x["count"]) for x in r] == [(1, 5.0, 5.0, 2)]
    some = spark.createDataFrame([(float(i), 1.0) for i in range(20)] + [(None, 99.0)], "y double, e double")
    r = DG.error_by_quantile_bucket(some).collect()
    assert sum(x["count"] for x in r) == 20 and all(x["mean"] == 1.0 for x in r)


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)] + [(float("nan"),), (None,)], "x double")
    h = profile.histogram(df, F.col("x"), 5).collect()
    assert [r["count"] for r in h] == [2] * 5 and h[0]["lo"] == 0.0
    assert profile.not_a_number(df, ["x"]).first()["nans"] == 1


def test_normal_quantile_matches_the_library(spark):
    from statistics import NormalDist

    ps = [1e-12, 1e-6, 0.01, 0.07, 0.075, 0.3, 0.5, 0.9, 0.9999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select("p", DG.normal_quantile(F.col("p")).alias("z"))
    for r in df.collect():
        assert abs(r["z"] - NormalDist().inv_cdf(r["p"])) < 1e-9


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "b"), (None, "a"), (9.0, None)], "x double, c string")
    assert FT.Imputer(["x"]).fit(df).values == {"x": 3.0}
    assert FT.Imputer(["c"], "most_frequent").fit(df).values == {"c": "a"}       # tie: the smaller value
    done = FT.Imputer(["c"], "constant", "?").fit(df).transform(df)
    assert [r["c"] for r in done.collect()][-1] == "?"
    assert FT.Imputer(["x"], fill=0.0).fit(df.where("x IS NULL")).values == {"x": 0.0}


def test_error_text_is_cut_and_run_tag_formatted(spark, tmp_path):
    from datetime import datetime

    from cabline.plans.ingest import RUN_TAG_FORMAT, default_run_tag

    path = str(tmp_path / "ledger")
    LG.append_ledger(spark, path, "yellow", 2024, 1, LG.ERROR, error="x" * 501)
    row = LG.read_ledger(spark, path).first()
    assert row["error"] == "x" * 500
    datetime.strptime(default_run_tag(), RUN_TAG_FORMAT)
