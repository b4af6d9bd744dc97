"""Modelling job: features -> design -> Gram statistics -> models -> boards -> report.

One pass over the rows gives the Gram statistics of every split (and every CV fold);
all models and grid points are solved from them on the driver (p x p work) and all
validation/test scores are computed in one more pass each.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from cabline.operators import diagnose as DG
from cabline.operators import features as FT
from cabline.operators import linear as LN
from cabline.operators.estimators import PenalisedRegression
from cabline.operators.gram import Gram, collect_grams
from cabline.operators.ranking import rank_within
from cabline.session import drop_path, materialize, materialize_at
from cabline.sources.conform import require_columns

# Model settings and search grids of the original study.
SCRATCH = {"SGD": dict(learning_rate=0.01, max_iter=1000), "Ridge": dict(alpha=1.0),
           "Lasso": dict(alpha=0.1), "ElasticNet": dict(alpha=0.1, l1_ratio=0.5)}
LIBRARY = {"SGD": dict(alpha=0.01, max_iter=1000), "Ridge": dict(alpha=1.0),
           "Lasso": dict(alpha=0.1), "ElasticNet": dict(alpha=0.1, l1_ratio=0.5)}
SCRATCH_GRID = {
    "SGD": {"learning_rate": [1e-2, 5e-3], "max_iter": [1000, 3000], "alpha": [0.0, 1e-3, 1e-2]},
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0]},
    "Lasso": {"alpha": [0.01, 0.1, 0.5]},
    "ElasticNet": {"alpha": [0.01, 0.1, 0.5], "l1_ratio": [0.2, 0.5, 0.8]},
}
INTERCEPT_GRID = {
    "SGD": {"alpha": [0.001, 0.01]},
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0]},
    "Lasso": {"alpha": [0.01, 0.1, 0.5]},
    "ElasticNet": {"alpha": [0.01, 0.1, 0.5], "l1_ratio": [0.2, 0.5, 0.8]},
}
#: Library models that MLlib fits by iterating over the rows.
ITERATED = ("Lasso", "ElasticNet")
CV_FOLDS = 3
#: Mini-batches of the descent comparator and the seed that deals rows to them.
SGD_BATCHES, SGD_SEED = 32, 42
BOARD_SCHEMA = ("model string, type string, val_rmse double, val_mae double, val_r2 double, "
                "train_time double, n_features int")
TEST_SCHEMA = "model string, type string, test_rmse double, test_mae double, test_r2 double, params map<string,double>"


def scratch_fit(name: str, g, **p) -> LN.LinearFit:
    if name == "SGD":
        return LN.gradient_descent(g, p.get("learning_rate", 0.01), p.get("max_iter", 1000), 1e-4, p.get("alpha", 0.0))
    if name == "Ridge":
        return LN.ridge(g, p.get("alpha", 1.0))
    if name == "Lasso":
        return LN.lasso(g, p.get("alpha", 1.0))
    return LN.elastic_net(g, p.get("alpha", 1.0), p.get("l1_ratio", 0.5))


def combos(grid: dict):
    keys = list(grid)
    for vals in itertools.product(*[grid[k] for k in keys]):
        yield dict(zip(keys, vals))


@dataclass
class ModelRun:
    """design: rows (split, y, x, pickup_datetime), stored or computed from stored columns.
    width: entries of x. grams: statistics of each split. batches: those of the training
    rows' mini-batches."""

    design: DataFrame
    width: int
    grams: dict
    batches: list
    results: dict = field(default_factory=dict)


def run_of(design: DataFrame, width: int, batches: int = SGD_BATCHES, stored: bool = False) -> ModelRun:
    """Stores the design, unless it is cheap to read again (``stored``), and gathers all
    statistics in one pass: the training rows by mini-batch (a hash of the row's content, so
    any partitioning deals them alike)."""
    if not stored:
        design = materialize(design, "design")
    batch = F.pmod(F.xxhash64(F.lit(SGD_SEED), "x", "y"), F.lit(batches))
    key = F.when(F.col("split") == "train", F.concat_ws("/", "split", batch)).otherwise(F.col("split"))
    grams = collect_grams(design.withColumn("_g", key), width, "_g")
    parts = [grams[k] for k in sorted(grams) if k.startswith("train/")]
    whole = {k: grams.get(k, Gram.empty(width)) for k in ("validation", "test")}
    return ModelRun(design, width, {"train": sum(parts, start=Gram.empty(width)), **whole}, parts)


def prepare(sample: DataFrame) -> ModelRun:
    """The prepared columns are stored, not the design made of them: a row of the design is
    several times as wide, and a pass that needs one split then builds only that one's rows."""
    f = FT.split_by_month(FT.prepare_features(FT.create_features(sample)))
    columns = [*FT.NUMERIC, *FT.CATEGORICAL, *FT.BINARY]
    require_columns(f, [*columns, FT.TARGET])
    f = materialize(f.select("split", F.col(FT.TARGET).alias("y"), "pickup_datetime", *columns), "features")
    pre = FT.Preprocessor().fit(f.where("split = 'train'"))
    return run_of(pre.transform(f, keep=["split", "y", "pickup_datetime"]), len(pre.feature_names()), stored=True)


def _board(spark: SparkSession, design: DataFrame, fits: list, kinds: list, split: str) -> DataFrame:
    sc = {r["model"]: r for r in LN.score_many(design.where(F.col("split") == split), fits).collect()}
    rows = []
    for f, kind in zip(fits, kinds):
        r = sc[f.name]
        nz = 0 if kind == "Baseline" else f.n_nonzero()
        rows.append((f.name, kind, r["rmse"], r["mae"], r["r2"], float(f.fit_seconds), int(nz)))
    return spark.createDataFrame(rows, BOARD_SCHEMA)


def library_fit(run: ModelRun, name: str, vectors: DataFrame | None = None, **p) -> LN.LinearFit:
    """Comparator with intercept: Ridge from the statistics (what MLlib's normal solver
    computes; a test holds them equal), SGD as mini-batch descent, Lasso and ElasticNet by
    MLlib's own iterations over the training rows (``vectors``, if they are stored)."""
    if name == "SGD":
        return LN.minibatch_descent(run.batches, **p)
    if name == "Ridge":
        return LN.intercept_fit(name, run.grams["train"], **p)
    return LN.mllib_fit(training_vectors(run) if vectors is None else vectors, name, **p)


def as_vectors(rows: DataFrame, width: int, keep: Sequence[str] = ("y",)) -> DataFrame:
    """Rows (_v, kept columns) as MLlib takes them, with vectors that leave out zeros."""
    dense = rows.select(array_to_vector("x").alias("_d"), *keep)
    sized = VectorSizeHint(inputCol="_d", size=width, handleInvalid="optimistic").transform(dense)
    return VectorAssembler(inputCols=["_d"], outputCol="_v").transform(sized).select("_v", *keep)


def training_vectors(run: ModelRun) -> DataFrame:
    """Training rows (_v, y) for MLlib."""
    return as_vectors(run.design.where("split = 'train'"), run.width)


def leaderboard(spark: SparkSession, run: ModelRun, library: dict = LIBRARY) -> DataFrame:
    """Validation board: from-scratch, library and two baselines, by val RMSE."""
    g = run.grams["train"]
    fits, kinds = [], []
    for name, p in SCRATCH.items():
        f = scratch_fit(name, g, **p)
        f.name = f"{name} (From Scratch)"
        fits.append(f); kinds.append("From Scratch")
    # Each MLlib fit reads its rows three times and iterates over a copy that it keeps in the
    # executors: the vectors are stored once for all fits, and one fit runs at a time
    vectors, path = None, None
    if any(name in ITERATED for name in library):
        vectors, path = materialize_at(training_vectors(run), "vectors")
    for name, p in library.items():
        f = library_fit(run, name, vectors, **p)
        f.name = f"{name} (Library)"
        fits.append(f); kinds.append("Library")
    if path is not None:
        drop_path(spark, path)
    mean, med = DG.baseline_predictions(run.design.where("split = 'train'"))
    fits += [LN.constant_fit("Baseline (Mean)", g.p, mean), LN.constant_fit("Baseline (Median)", g.p, med)]
    kinds += ["Baseline", "Baseline"]
    return _board(spark, run.design, fits, kinds, "validation").orderBy("val_rmse", "model")


#: A point must beat the best before it by more than this; equal ones keep the grid's order.
NEAR = 1e-9


def grid_holdout(run: ModelRun, grids: dict = SCRATCH_GRID) -> dict:
    """Every grid point solved from the train Gram, scored on the validation Gram;
    the first minimum of validation RMSE wins per family."""
    g, gv = run.grams["train"], run.grams["validation"]
    best = {}
    for name, grid in grids.items():
        best[name] = {"rmse": np.inf, "params": None}
        for cfg in combos(grid):
            f = scratch_fit(name, g, **cfg)
            r = LN.rmse_from_gram(gv, f)
            if r < best[name]["rmse"] - NEAR:
                best[name] = {"rmse": r, "params": cfg, "fit": f}
    return best


#: Seconds given to rows without a time, which come first.
NO_TIME = -(1 << 62)
#: Rows of the folds' first seconds that one task ranks: a few rows need no range sampling.
RANKED_ROWS = 50_000


def _seconds(df: DataFrame, time_col: str) -> Column:
    """Whole seconds of a time, never falling when the time grows in any time zone."""
    t = F.col(time_col)
    if isinstance(df.schema[time_col].dataType, TimestampType):
        return F.coalesce(F.unix_seconds(t), F.lit(NO_TIME))
    t = t.cast("timestamp_ntz")
    clock = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.coalesce(F.unix_date(t.cast("date")).cast("long") * 86_400 + clock, F.lit(NO_TIME))


def _cells_of(starts: list[int], counts: list[tuple[int, int]], before: int = 0) -> list[tuple[int, int, int]]:
    """(start, cell, rows before the cell) of each start that falls into one of the cells."""
    out = []
    for cell, n in sorted(counts):
        out += [(s, cell, before) for s in starts if before <= s < before + n]
        before += n
    return out


def time_folds(run: ModelRun, folds: int = CV_FOLDS) -> DataFrame:
    """Training rows with ``fold`` 0, 1, ...: contiguous, unshuffled parts (NTILE) in order of
    time, x and y.

    Only the rows around a fold's start need a rank. Counts by day, and by second within the
    days that hold a start, find the seconds in which folds begin; every other row's fold
    follows from its time, and the rows of those seconds are ranked.
    """
    train = run.design.where("split = 'train'")
    timed = train.withColumn("_s", _seconds(train, "pickup_datetime"))
    day = F.floor(F.col("_s") / 86_400)
    count = F.count(F.lit(1)).alias("n")
    days = [tuple(r) for r in timed.groupBy(day.alias("d")).agg(count).collect()]          # a row a day
    q, r = divmod(sum(n for _, n in days), folds)
    found = _cells_of([k * q + min(k, r) for k in range(1, folds)], days)
    opened = sorted({d for s, d, before in found if before < s})
    at: dict[int, list] = {}                                                              # a row a second of these days
    for d, s, n in timed.where(day.isin(opened)).groupBy(day.alias("d"), "_s").agg(count).collect() if opened else ():
        at.setdefault(d, []).append((s, n))
    fold, ranked, inside = F.lit(0), F.lit(0), set()
    for start, d, before in found:
        second, start_in = d * 86_400, 0
        if before < start:
            (_, second, off), = _cells_of([start], at[d], before)
            start_in = start - off
        if start_in:                                                                      # within the second
            inside.add(second)
        past = (F.col("_s") > second) if start_in else (F.col("_s") >= second)
        fold = fold + past.cast("int")
        ranked = ranked + F.when(F.col("_s") == second, F.col("_rn") > start_in).otherwise(past).cast("int")
    folded = timed.where(~F.col("_s").isin(sorted(inside))).withColumn("fold", fold.cast("int"))
    if inside:
        order = [F.asc_nulls_first("pickup_datetime"), F.asc("x"), F.asc("y")]
        tied = sum(n for cells in at.values() for s, n in cells if s in inside)
        most = int(timed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        close = rank_within(timed.where(F.col("_s").isin(sorted(inside))), ["_s"], order, min(most, tied // RANKED_ROWS + 1))
        folded = folded.unionByName(close.withColumn("fold", ranked.cast("int")).drop("_rn", "_n"))
    return folded.drop("_s")


def grid_cv(run: ModelRun, folds: int = CV_FOLDS, grids: dict = INTERCEPT_GRID) -> dict:
    """k-fold CV of the grid of intercept models: fold statistics subtract from the train total, so
    each fold's fit needs no pass over the data; best by mean fold RMSE, refit on train.
    ``curve`` holds every point's mean."""
    fg = collect_grams(time_folds(run, folds), run.width, "fold")
    total = run.grams["train"]
    best = {}
    for name, grid in grids.items():
        best[name] = {"cv_rmse": np.inf, "params": None, "curve": []}
        for cfg in combos(grid):
            scores = [LN.rmse_from_gram(fg[k], LN.intercept_fit(name, total - fg[k], **cfg)) for k in sorted(fg)]
            m = float(np.mean(scores))
            best[name]["curve"].append((cfg, m))
            if m < best[name]["cv_rmse"] - NEAR:
                best[name].update({"cv_rmse": m, "params": cfg})
        f = LN.intercept_fit(name, total, **best[name]["params"])
        best[name]["fit"] = f
        best[name]["rmse"] = LN.rmse_from_gram(run.grams["validation"], f)
    return best


def grid_cv_library(run: ModelRun, grids: dict, folds: int = CV_FOLDS, parallelism: int = 4) -> dict:
    """The same search by Spark's ``CrossValidator``: MLlib fits over the rows of each fold,
    ``parallelism`` of them at a time. ``curve`` holds every point's mean fold RMSE. Each fit
    passes over its rows three times, so the rows are stored, and kept by the validator, as
    vectors."""
    rows = materialize(as_vectors(time_folds(run, folds), run.width, ("y", "fold")), "folds")
    best = {}
    for name, grid in grids.items():
        base = PenalisedRegression(kind=name, solver="mllib", featuresCol="_v")
        points = list(combos(grid))
        maps = [{base.getParam({"l1_ratio": "l1Ratio"}.get(k, k)): float(v) for k, v in cfg.items()} for cfg in points]
        search = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"),
                                numFolds=folds, foldCol="fold", parallelism=parallelism)
        found = search.fit(rows)
        k = int(np.argmin(found.avgMetrics))
        best[name] = {"cv_rmse": float(found.avgMetrics[k]), "params": points[k], "curve": list(zip(points, found.avgMetrics)),
                      "fit": found.bestModel.as_fit(), "model": found.bestModel.copy({found.bestModel.featuresCol: "x"})}
        best[name]["rmse"] = LN.rmse_from_gram(run.grams["validation"], best[name]["fit"])
    return best


def refit_test(spark: SparkSession, run: ModelRun, best_fs: dict, best_lib: dict) -> DataFrame:
    """Best configurations refitted on train + validation (the preprocessor is kept),
    scored on test together with the two train baselines, in one pass."""
    g = run.grams["train"] + run.grams["validation"]
    fits, kinds, params = [], [], []
    for name, b in best_fs.items():
        f = scratch_fit(name, g, **b["params"]); f.name = f"{name} (From Scratch)"
        fits.append(f); kinds.append("From Scratch"); params.append(b["params"])
    for name, b in best_lib.items():
        f = LN.intercept_fit(name, g, **b["params"]); f.name = f"{name} (Intercept)"
        fits.append(f); kinds.append("Intercept"); params.append(b["params"])
    mean, med = DG.baseline_predictions(run.design.where("split = 'train'"))
    fits += [LN.constant_fit("Baseline (Mean)", g.p, mean), LN.constant_fit("Baseline (Median)", g.p, med)]
    kinds += ["Baseline", "Baseline"]
    params += [{}, {}]
    sc = {r["model"]: r for r in LN.score_many(run.design.where("split = 'test'"), fits).collect()}
    rows = [(f.name, k, sc[f.name]["rmse"], sc[f.name]["mae"], sc[f.name]["r2"],
             {n: float(v) for n, v in p.items()}) for f, k, p in zip(fits, kinds, params)]
    run.results["test_fits"] = {f.name: f for f in fits}
    return spark.createDataFrame(rows, TEST_SCHEMA).orderBy("test_rmse", "model")


def best_model(test_board: DataFrame, by: str = "test_rmse") -> DataFrame:
    """The non-baseline row with the lowest score (ties by name)."""
    return test_board.where(~F.col("model").contains("Baseline")).orderBy(by, "model").limit(1)


def report(spark: SparkSession, run: ModelRun, test_board: DataFrame) -> DataFrame:
    """Winner, its test scores, gain over the mean baseline, family averages and the
    winner's absolute-error percentiles, as one row."""
    board = {r["model"]: r for r in test_board.collect()}
    win = best_model(test_board).first()
    base = board["Baseline (Mean)"]
    fs, with_b = ([r["test_rmse"] for r in board.values() if r["type"] == kind] for kind in ("From Scratch", "Intercept"))
    fit = run.results["test_fits"][win["model"]]
    res = run.design.where("split = 'test'").select((F.col("y") - LN.predict(fit)).alias("e"))
    pct = DG.abs_error_percentiles(materialize(res, "residuals")).first()        # read several times
    row = (win["model"], win["test_rmse"], win["test_mae"], win["test_r2"],
           (base["test_rmse"] - win["test_rmse"]) / base["test_rmse"] * 100.0,
           float(np.mean(fs)), float(np.mean(with_b)), pct["p50"], pct["p80"], pct["p95"], pct["pct_lt_3"])
    return spark.createDataFrame([row], "winner string, test_rmse double, test_mae double, test_r2 double, "
                                        "improvement_pct double, avg_rmse_scratch double, avg_rmse_intercept double, "
                                        "abs_p50 double, abs_p80 double, abs_p95 double, pct_lt_3 double")


def grid_frame(spark: SparkSession, best: dict, kind: str) -> DataFrame:
    rows = [(f"{k} ({kind})", float(v["rmse"]), {a: float(b) for a, b in v["params"].items()})
            for k, v in best.items()]
    return spark.createDataFrame(rows, "model string, val_rmse double, params map<string,double>")


def run_job(spark: SparkSession, wide_path: str, out: str, years, rows_per_year: int) -> dict:
    """Whole modelling job over a stored wide table; every result is written as a table."""
    from cabline.operators.sample import quality_filter, stratified_time_sample

    wide = spark.read.parquet(wide_path)
    sample = materialize(stratified_time_sample(quality_filter(wide, years), rows_per_year), "sample")
    run = prepare(sample)
    boards = {"leaderboard": leaderboard(spark, run)}
    best_fs, best_lib = grid_holdout(run), grid_cv(run)
    boards["grid_holdout"] = grid_frame(spark, best_fs, "From Scratch")
    boards["grid_cv"] = grid_frame(spark, best_lib, "Intercept")
    test_board = refit_test(spark, run, best_fs, best_lib)
    boards["test"] = test_board
    boards["best"] = best_model(test_board)
    boards["report"] = report(spark, run, test_board)
    for name, df in boards.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
    return {k: f"{out.rstrip('/')}/{k}" for k in boards}


def main(argv=None) -> None:
    import argparse

    ap = argparse.ArgumentParser(description="Sample the wide table, fit, tune and diagnose the models")
    ap.add_argument("--wide", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--years", default="2024", help="comma-separated years to sample")
    ap.add_argument("--rows-per-year", type=int, default=100_000)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    res = run_job(spark, a.wide, a.out, [int(y) for y in a.years.split(",")], a.rows_per_year)
    spark.read.parquet(res["report"]).show(truncate=False)


if __name__ == "__main__":
    main()
