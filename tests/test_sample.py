"""NTILE closed form and bucketed ranks versus brute force."""

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from cabline.operators.ranking import _ranged, rank_within
from cabline.operators.selection import exact_percentiles
from cabline.operators.sample import first_of_ntile, ntile_of


def _ntile(n, k):
    q, r = divmod(n, k)
    out = []
    for b in range(k):
        size = q + 1 if b < r else q
        out += [b + 1] * size
    return out


def test_ntile_formula(spark):
    rng = random.Random(7)
    pairs = [(n, k) for n in (1, 2, 5, 12, 13, 40) for k in (1, 2, 5, 12, 50)] + \
            [(rng.randint(1, 300), rng.randint(1, 60)) for _ in range(20)]
    rows = [(i, n, k, rn) for i, (n, k) in enumerate(pairs) for rn in range(1, n + 1)]
    df = spark.createDataFrame(rows, "pair int, n long, k int, rn long")
    got = df.select("pair", "rn", ntile_of(F.col("rn"), F.col("n"), F.col("k")).alias("b"),
                    first_of_ntile(F.col("rn"), F.col("n"), F.col("k")).alias("first")).collect()
    expect = {}
    for i, (n, k) in enumerate(pairs):
        t = _ntile(n, k)
        for rn in range(1, n + 1):
            expect[(i, rn)] = (t[rn - 1], rn == 1 or t[rn - 1] != t[rn - 2])
    for r in got:
        assert (r["b"], r["first"]) == expect[(r["pair"], r["rn"])]


def test_rank_within_matches_window(spark):
    rng = random.Random(3)
    # one hot stratum holding most rows, many tied keys
    rows = [(("hot" if rng.random() < 0.6 else f"s{rng.randint(0, 5)}"), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t int, id int")
    order = [F.asc_nulls_first("t"), F.asc("id")]
    got = rank_within(df, ["g"], order, partitions=8).select("id", "_rn", "_n")
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("rn"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"))
    diff = got.join(ref, "id").where("_rn != rn OR _n != n").count()
    assert diff == 0


def test_exact_percentiles_match_pandas(spark):
    rng = random.Random(11)
    vals = [float(rng.choice([5.0, 5.0, 5.0, rng.uniform(0, 100)])) for _ in range(2001)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "v double, g int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.8, 0.95, 1.0]
    got = {r["g"]: r["q"] for r in exact_percentiles(df, "v", probs, ["g"]).collect()}
    pdf = pd.DataFrame({"v": vals, "g": [i % 3 for i in range(len(vals))]})
    for g, grp in pdf.groupby("g"):
        for a, b in zip(got[g], grp["v"].quantile(probs).tolist()):
            assert abs(a - b) < 1e-9


def test_null_strata_and_hot_ties_spread_over_partitions(spark):
    """A NULL stratum keeps its rows, and a tied value that two thirds of the rows hold is
    dealt out to several partitions."""
    rows = [(None if i % 5 == 0 else "s", 7.0 if i % 3 else float(i), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, t double, id int").repartition(4)
    order = [F.asc_nulls_first("t"), F.asc("id")]
    got = rank_within(df, ["g"], order, partitions=12).select("g", "id", "_rn", "_n")
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("rn"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"))
    assert got.count() == 6000 and got.join(ref, "id").where("_rn <> rn OR _n <> n").count() == 0
    dealt = _ranged(df, ["g"], order, 12).groupBy("_p").count().agg(F.max("count")).first()[0]
    assert dealt < 2000
    q = {r["g"]: r for r in exact_percentiles(df, "t", [0.0, 0.5, 1.0], ["g"]).collect()}
    assert set(q) == {None, "s"} and q[None]["q"][1] == 7.0 and q[None]["_n"] == 1200
