"""Quantiles by narrowing against NumPy, on values that are hard to narrow."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabline.operators import selection as S

PROBS = [0.0, 0.01, 0.25, 0.5, 0.8, 0.95, 1.0]


def hard_values():
    rng = np.random.default_rng(7)
    yield "normal", rng.normal(size=3_001)
    yield "ties", np.repeat([1.0, 2.0, 2.0, 7.0], [900, 5, 1_000, 3])
    yield "scales", np.concatenate([10.0 ** rng.integers(-300, 300, 500), -(10.0 ** rng.integers(-300, 300, 500)), [0.0] * 7])
    yield "neighbours", 1.0 + np.arange(500) * np.finfo(float).eps
    yield "one", np.array([-3.25])
    yield "signs", np.array([-0.5, 0.0, 0.5, -1e-310, 1e-310, 4.0])


@pytest.mark.parametrize("name,values", list(hard_values()))
def test_equals_sorting(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    row = S.exact_percentiles(df, "v", PROBS).first()
    s, want = np.sort(values), []
    for p in PROBS:
        h = (len(s) - 1) * p
        want.append(s[math.floor(h)] + (s[math.ceil(h)] - s[math.floor(h)]) * (h - math.floor(h)))
    assert row["_n"] == len(values) and np.array_equal(row["q"], want)


def test_groups_nulls_and_nan(spark):
    rows = [("a", float(i % 17)) for i in range(400)] + [(None, 5.0), (None, 6.0), ("b", None), ("c", float("nan")), ("c", 1.0), ("c", float("inf"))]
    got = {r["g"]: r["q"] for r in S.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), "v", [0.0, 0.5, 1.0], ["g"]).collect()}
    assert set(got) == {"a", None, "c"} and got[None] == [5.0, 5.5, 6.0] and got["a"] == [0.0, 8.0, 16.0]
    assert got["c"][0] == 1.0 and math.isinf(got["c"][1]) and math.isnan(got["c"][2])


def test_magnitude_never_falls(spark):
    v = sorted([0.0, 1.0, 2.0, 1.9999999999999998, 4.9e-324, 1.7e308, float("inf"), 3.0, 0.5, 0.49999999999999994, -1e-320, -1.0, -2.0, float("-inf")])
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v double").orderBy("i").select(S.magnitude(F.col("v"))).collect()]
    assert got == sorted(got)


def test_the_rows_are_neither_sorted_nor_written(spark, tmp_path):
    from cabline import session

    before = len(session._WRITTEN)
    df = spark.range(100_000).select((F.col("id") * 37 % 99_991).cast("double").alias("v"))
    out = S.exact_percentiles(df, "v", [0.5])
    assert out.first()["q"] == [np.median(np.arange(100_000) * 37 % 99_991)]
    sizes = [spark.read.parquet(p).count() for p in session._WRITTEN[before:]]
    assert sizes and max(sizes) <= 2
