"""Steps that keep shuffled and ranked rows few: narrow joins and clusters, partition
conditions that reach the sources, folds from counts, designs built on the fly."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Window
from pyspark.sql import functions as F

from cabline.operators import features as FT
from cabline.operators import estimators as ES
from cabline.operators import linear as LN
from cabline.operators.wide import build_wide
from cabline.plans import bindings as B
from cabline.plans import model as MJ
from cabline.sources import sinks


def _wide_source(spark):
    parts = [spark.range(0, 3_000, 1, 8).select((F.col("id") % 3 + 2020).cast("int").alias("source_year"), F.lit(s).alias("service_type"),
                                                F.timestamp_seconds(F.col("id") * k).alias("pickup_datetime"), "id") for s, k in (("yellow", 7), ("green", 11))]
    return parts[0].unionByName(parts[1])


def test_wanted_partitions_reach_the_sources(spark, tmp_path, monkeypatch):
    """the rows of other services are left out of the plan, not filtered after the union."""
    seen, write = [], sinks._write_counted
    monkeypatch.setattr(sinks, "_write_counted", lambda df, *a: seen.append(df) or write(df, *a))
    got = sinks.partition_replace(spark, _wide_source(spark), str(tmp_path / "t"), [(2021, "yellow")], overwrite=True)
    assert got["written"] == 1_000 and got["new"] == [(2021, "yellow")]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert {tuple(r) for r in stored.select("source_year", "service_type").distinct().collect()} == {(2021, "yellow")}


def _trip_tables(spark, base):
    at = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(i % 9 if i % 5 else None, 1, 1, i % 7 + 1, float(i % 50 + 1), 900.0 + i, 0.05, 0.02, "ANR"[i % 3], "FO"[i % 2], at + dt.timedelta(days=i % 900))
                           for i in range(400)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{base}/lineitem.parquet")
    spark.createDataFrame([(k, k % 3 if k != 4 else None, at + dt.timedelta(days=200 * k)) for k in (0, 1, 2, 3, 3, 4, 5, 8)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{base}/orders.parquet")
    spark.createDataFrame([(0, 3), (1, 4), (1, 5)], "c_custkey long, c_nationkey int").write.parquet(f"{base}/customer.parquet")
    spark.createDataFrame([(1, 2)], "s_suppkey long, s_nationkey int").write.parquet(f"{base}/supplier.parquet")


def test_line_items_join_once_by_order(spark, tmp_path):
    """customers join the orders, not the joined line items; repeated and null keys as before."""
    _trip_tables(spark, str(tmp_path))
    got = B.trips(spark, str(tmp_path))
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-|"))
    k, = [i for i, s in enumerate(lines) if "Join LeftOuter" in s and "o_custkey" in s]
    under = [s for s in lines[k + 1:] if depth(s) > depth(lines[k])]
    assert under and not any("l_extendedprice" in s for s in under)
    l, o, c = (B.table(spark, str(tmp_path), n) for n in ("lineitem", "orders", "customer"))
    plain = l.join(o, l.l_orderkey == o.o_orderkey, "left").join(c, F.col("o_custkey") == c.c_custkey, "left")
    count = lambda df, *k: sorted(map(str, df.groupBy(*k).count().collect()))
    want = plain.select(F.when(~((F.col("l_linenumber") == 6) & (F.col("l_quantity") <= 2)), F.col("c_nationkey")).alias("PULocationID"), (F.col("l_extendedprice") / 1000).alias("fare_amount"))
    assert count(got, "PULocationID", "fare_amount") == count(want, "PULocationID", "fare_amount")


def test_clustered_build_shuffles_raw_columns(spark, tmp_path):
    """zone names and labels are added after the rows were brought together; a partition
    still has a file or two."""
    _trip_tables(spark, str(tmp_path))
    zones = spark.createDataFrame([(i, f"z{i}", "b", "s") for i in range(9)], "locationid int, zone string, borough string, service_zone string")
    raw = {s: B.raw_service(spark, str(tmp_path), s) for s in ("yellow", "green")}
    wide, plain = build_wide(raw, zones, clustered=True), build_wide(raw, zones)
    lines = wide._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-|"))
    at = [i for i, s in enumerate(lines) if "RebalancePartitions" in s]
    assert len(at) == 2
    for k in at:
        under = []
        for s in lines[k + 1:]:
            if depth(s) <= depth(lines[k]):
                break
            under.append(s)
        assert under and not any("vendor_name" in s or "zone#" in s for s in under)
    assert sinks.full_rebuild(wide, str(tmp_path / "w"), overwrite=True, clustered=True) == plain.count()
    stored = spark.read.parquet(str(tmp_path / "w")).select(*plain.columns)
    assert stored.exceptAll(plain).isEmpty() and plain.exceptAll(stored).isEmpty()
    files = [p for p in (tmp_path / "w").rglob("*.parquet")]
    assert len(files) <= 2 * stored.select("source_year", "service_type").distinct().count()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("folds", [1, 3, 7])
def test_folds_by_counts_equal_ntile(spark, monkeypatch, kind, folds):
    """contiguous folds with ties, missing times and part-seconds; only rows near a
    fold's start are ranked."""
    micros = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 5_000_000).otherwise(F.pmod(F.hash("id"), F.lit(90)) * 13_337_000_777)
    rows = spark.range(500).select(F.lit("train").alias("split"), (F.col("id") % 4).cast("double").alias("y"), F.array((F.col("id") % 6).cast("double")).alias("x"),
                                   F.timestamp_micros(micros).cast(kind).alias("pickup_datetime"), "id")
    ranked, rank = [], MJ.rank_within
    monkeypatch.setattr(MJ, "rank_within", lambda df, *a: ranked.append(df.count()) or rank(df, *a))
    run = MJ.ModelRun(rows.drop("id"), 1, {}, [])
    key = ["pickup_datetime", "x", "y"]
    got = MJ.time_folds(run, folds).select(*key, "fold")
    order = Window.orderBy(F.asc_nulls_first("pickup_datetime"), F.asc("x"), F.asc("y"))
    want = rows.select(*key, (F.ntile(folds).over(order) - 1).alias("fold"))
    count = lambda df: sorted((str(r[0]), r[1], r[2], r["fold"], r["n"]) for r in df.groupBy(*key, "fold").agg(F.count(F.lit(1)).alias("n")).collect())
    assert count(got) == count(want)
    assert sum(ranked) < 400


def test_more_folds_than_rows(spark):
    rows = spark.range(2).select(F.lit("train").alias("split"), F.lit(1.0).alias("y"), F.array(F.lit(1.0)).alias("x"), F.timestamp_seconds("id").alias("pickup_datetime"))
    assert sorted(r["fold"] for r in MJ.time_folds(MJ.ModelRun(rows, 1, {}, []), 5).collect()) == [0, 1]


def test_design_vector_equals_its_columns(spark):
    """a category block built around its one equals a comparison a column."""
    df = spark.createDataFrame([(1.5, "a", 3, 1), (-2.0, "b", None, 0), (0.0, None, 4, 1), (7.0, "zz", 3, 0)], "n double, c string, k long, f int")
    pre = FT.Preprocessor(numeric=("n",), categorical=("c", "k"), binary=("f",), interaction=("n", "n"))
    pre.fit(df.where("c IS NULL OR c <> 'zz'"))
    both = df.select(pre.vector().alias("x"), F.array(*pre.columns()).alias("want")).collect()
    assert all(r["x"] == r["want"] and len(r["x"]) == len(pre.feature_names()) for r in both)
    plan = df.select(pre.vector().alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan


def test_job_stores_features_and_not_the_design(spark):
    """what ``prepare`` stores holds no design vector."""
    rows = spark.range(300).select(F.lit("yellow").alias("service_type"), (F.col("id") % 3).cast("int").alias("vendor_id"), (F.col("id") % 2).cast("int").alias("rate_code_id"),
                                   F.lit("b").alias("pu_borough"), F.concat(F.lit("z"), F.col("id") % 5).alias("pu_zone"), (F.col("id") % 24).cast("int").alias("pickup_hour"),
                                   (F.col("id") % 7).cast("int").alias("pickup_dow"), (F.col("id") % 12 + 1).cast("int").alias("month"), F.lit(2020).alias("year"),
                                   (F.col("id") % 17).cast("double").alias("trip_distance"), F.lit(1).alias("passenger_count"),
                                   *[(F.col("id") % k).cast("double").alias(c) for k, c in ((11, "fare_amount"), (3, "extra"), (2, "mta_tax"), (5, "improvement_surcharge"),
                                                                                         (4, "congestion_surcharge"), (6, "airport_fee"), (13, "total_amount"))],
                                   F.timestamp_seconds(F.col("id") * 9_999).alias("pickup_datetime"))
    run = MJ.prepare(rows)
    files = run.design.inputFiles()
    assert files and "x" not in spark.read.parquet(*files).columns
    x = np.array([r["x"] for r in run.design.where("split = 'train'").collect()])
    assert x.shape[1] == run.width and np.allclose(x.T @ x, run.grams["train"].xtx)


def test_iterating_fits_share_stored_vectors(spark, monkeypatch):
    """MLlib's fits read sparse vectors that were stored once, one fit at a time."""
    category = F.array(*[F.when(F.col("id") % 12 == k, 1.0).otherwise(0.0) for k in range(12)])
    rows = spark.range(400).select(F.when(F.col("id") % 4 == 0, "validation").otherwise("train").alias("split"), (F.col("id") % 12 * 3.0 + F.col("id") % 7).alias("y"),
                                   F.concat(F.array((F.col("id") % 7).cast("double")), category).alias("x"), F.timestamp_seconds("id").alias("pickup_datetime"))
    run = MJ.run_of(rows, 13)
    seen, running, fit = [], [], LN.mllib_fit

    def spied(train, kind, **p):
        running.append(kind)
        assert len(running) == 1
        seen.append((train.columns, sorted(train.inputFiles()), train.where("_v IS NULL").count(), [r["_v"] for r in train.collect()]))
        out = fit(train, kind, **p)
        running.remove(kind)
        return out
    monkeypatch.setattr(LN, "mllib_fit", spied)
    board = {r["model"]: r for r in MJ.leaderboard(spark, run).collect()}
    assert [s[0] for s in seen] == [["_v", "y"]] * 2
    assert seen[0][1] and seen[0][1] == seen[1][1] and "vectors-" in seen[0][1][0]
    want = sorted(tuple(r["x"]) for r in rows.where("split = 'train'").collect())
    assert seen[0][2] == 0 and sorted(tuple(float(c) for c in v.toArray()) for v in seen[0][3]) == want
    assert all(isinstance(v, SparseVector) for v in seen[0][3])
    plain = fit(run.design.where("split = 'train'").select("x", "y"), "Lasso", **MJ.LIBRARY["Lasso"])
    sc = LN.score_many(run.design.where("split = 'validation'"), [plain]).first()
    assert np.isclose(board["Lasso (Library)"]["val_rmse"], sc["rmse"], rtol=1e-9) and board["Lasso (Library)"]["n_features"] == plain.n_nonzero()


def test_library_search_reads_stored_vectors(spark, monkeypatch):
    """the validator's rows are vectors, made once; a fold's few tied rows are ranked in one task."""
    rows = spark.range(600).select(F.when(F.col("id") % 4 == 0, "validation").otherwise("train").alias("split"), (F.col("id") % 12 * 3.0 + F.col("id") % 7).alias("y"),
                                   F.array((F.col("id") % 7).cast("double"), F.when(F.col("id") % 5 == 0, 1.0).otherwise(0.0)).alias("x"), F.timestamp_seconds(F.col("id") / 7).alias("pickup_datetime"))
    run = MJ.run_of(rows, 2)
    seen, fit, dealt, rank = [], LN.mllib_fit, [], MJ.rank_within
    monkeypatch.setattr(LN, "mllib_fit", lambda train, kind, x="x", y="y", **p: seen.append((train.schema[x].dataType, len(train.columns), train.inputFiles())) or fit(train, kind, x, y, **p))
    monkeypatch.setattr(MJ, "rank_within", lambda df, by, order, partitions=None: dealt.append(partitions) or rank(df, by, order, partitions))
    found = MJ.grid_cv_library(run, {"Ridge": {"alpha": [0.1, 5.0]}})["Ridge"]
    assert len(seen) == 7 and all(isinstance(t, VectorUDT) and n == 2 for t, n, _ in seen) and "folds-" in seen[-1][2][0]
    assert dealt == [1]
    folded = MJ.time_folds(run).persist()
    for cfg, mean in found["curve"]:
        scores = []
        for k in range(MJ.CV_FOLDS):
            plain = fit(folded.where(F.col("fold") != k).select("x", "y"), "Ridge", **cfg)
            scores.append(LN.score_many(folded.where(F.col("fold") == k), [plain]).first()["rmse"])
        assert np.isclose(mean, np.mean(scores), rtol=1e-9)
    scored = found["model"].transform(run.design)
    assert np.allclose([r[0] for r in scored.select(F.col("prediction") - LN.predict(found["fit"])).collect()], 0.0)


def test_vectors_and_arrays_fit_alike(spark):
    rows = spark.range(60).select((F.col("id") % 9 * 1.0).alias("y"), F.array((F.col("id") % 4).cast("double"), F.lit(0.0)).alias("x"))
    both = MJ.as_vectors(rows, 2, ("x", "y"))
    for solver in ("gram", "mllib"):
        a, v = (ES.PenalisedRegression(kind="Ridge", alpha=0.5, solver=solver, featuresCol=c).fit(both) for c in ("x", "_v"))
        assert np.allclose(a.as_fit().weights, v.as_fit().weights) and np.isclose(a.as_fit().bias, v.as_fit().bias)
        assert both.select("x", "_v").count() == v.transform(a.transform(both).withColumnRenamed("prediction", "p")).where("abs(p - prediction) < 1e-9").count()
