"""Model diagnostics: residual statistics, error buckets, baselines, Q-Q points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.operators.profile import attach
from cabline.operators.ranking import global_row_number
from cabline.operators.selection import exact_median, exact_percentiles

# Price edges of the README's error buckets, intervals (a, b].
PRICE_EDGES = (0.0, 10.0, 20.0, 30.0, 50.0, 100.0, float("inf"))


def residual_stats(df: DataFrame, e: str = "e", digits: int = 6) -> DataFrame:
    """MAE, population std of residuals, median |e|, % of |e| < 2 and < 5."""
    a = df.select(F.col(e).alias("_e"), F.abs(F.col(e)).alias("_a"))
    base = a.agg(F.avg("_a").alias("mae"), F.stddev_pop("_e").alias("std"),
                 (F.avg((F.col("_a") < 2).cast("double")) * 100).alias("pct_lt_2"),
                 (F.avg((F.col("_a") < 5).cast("double")) * 100).alias("pct_lt_5"))
    med = exact_percentiles(a, "_a", [0.5]).select(F.col("q")[0].alias("median_abs"))
    out = attach(base, med)
    return out.select(*[F.round(c, digits).alias(c) for c in ("mae", "std", "median_abs", "pct_lt_2", "pct_lt_5")])


def abs_error_percentiles(df: DataFrame, e: str = "e", digits: int = 6) -> DataFrame:
    """p50 / p80 / p95 of |e| (linear interpolation) and % of |e| < 3."""
    a = df.select(F.abs(F.col(e)).alias("_a"))
    q = exact_percentiles(a, "_a", [0.5, 0.8, 0.95])
    share = a.agg((F.avg((F.col("_a") < 3).cast("double")) * 100).alias("pct_lt_3"))
    out = attach(q.select(F.col("q")[0].alias("p50"), F.col("q")[1].alias("p80"), F.col("q")[2].alias("p95")), share)
    return out.select(*[F.round(c, digits).alias(c) for c in ("p50", "p80", "p95", "pct_lt_3")])


def quantile_edges(df: DataFrame, col: str, q: int = 10) -> DataFrame:
    """One row: ``edges`` = distinct exact quantiles 0, 1/q, ..., 1 of ``col``."""
    probs = [i / q for i in range(q + 1)]
    return exact_percentiles(df, col, probs).select(F.array_distinct("q").alias("edges"))


def quantile_bucket(x: Column, edges: Column) -> Column:
    """Bucket of ``x`` among sorted ``edges``: intervals (a, b], the lowest edge included.
    NULL (and NaN) values belong to no bucket; a single edge is one bucket of its own."""
    below = F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < x)))
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), below)


def error_by_quantile_bucket(df: DataFrame, actual: str = "y", resid: str = "e", q: int = 10,
                             digits: int = 4) -> DataFrame:
    """Residual mean / sample std / count per decile bucket of the actual value."""
    edges = quantile_edges(df, actual, q)
    b = attach(df.select(actual, resid), edges).withColumn("bucket", quantile_bucket(F.col(actual), F.col("edges")))
    b = b.where(F.col("bucket").isNotNull())
    upper = F.coalesce(F.get("edges", F.col("bucket")), F.get("edges", F.col("bucket") - 1))
    return (b.groupBy("bucket").agg(F.first(F.get("edges", F.col("bucket") - 1)).alias("lo"),
                                    F.first(upper).alias("hi"),
                                    F.avg(resid).alias("mean"), F.stddev_samp(resid).alias("std"),
                                    F.count(F.lit(1)).alias("count"))
            .select("bucket", *[F.round(c, digits).alias(c) for c in ("lo", "hi", "mean", "std")], "count")
            .orderBy("bucket"))


def price_bucket(x: Column, edges: Sequence[float] = PRICE_EDGES) -> Column:
    """Index of the (a, b] interval holding x (NULL outside)."""
    expr = None
    for i in range(1, len(edges)):
        cond = (x > edges[i - 1]) & (x <= edges[i])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def error_by_price_bucket(df: DataFrame, actual: str = "y", resid: str = "e", digits: int = 4,
                          edges: Sequence[float] = PRICE_EDGES) -> DataFrame:
    b = df.withColumn("bucket", price_bucket(F.col(actual), edges)).where(F.col("bucket").isNotNull())
    return (b.groupBy("bucket").agg(F.avg(resid).alias("mean"), F.stddev_samp(resid).alias("std"),
                                    F.count(F.lit(1)).alias("count"))
            .select("bucket", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"), "count")
            .orderBy("bucket"))


def baseline_predictions(train: DataFrame, y: str = "y") -> tuple[float, float]:
    """Mean and exact median of the training target."""
    mean = train.agg(F.avg(y)).first()[0]
    med = exact_median(train, y).first()["median"]
    return float(mean), float(med)


# The rational approximation of the normal quantile, Wichura's published
# algorithm AS241 (Applied Statistics 37(3), 1988): numerators and denominators, highest
# power first, for the centre, the near tail and the far tail.
_CENTRE = ((2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
            13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
           (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
            5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0))
_NEAR = ((7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
          3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
         (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
          0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0))
_FAR = ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
         0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
        (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
         0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0))


def _ratio(table: tuple, x: Column) -> Column:
    def poly(coefficients):
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + F.lit(c)
        return out
    return poly(table[0]) / poly(table[1])


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile of 0 < p < 1 as one built-in expression."""
    q = p - 0.5
    tail = F.sqrt(-F.log(F.when(q <= 0, p).otherwise(1 - p)))
    outer = F.when(tail <= 5.0, _ratio(_NEAR, tail - 1.6)).otherwise(_ratio(_FAR, tail - 5.0))
    return F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRE, F.lit(0.180625) - q * q)).otherwise(F.signum(q) * outer)


def qq_points(df: DataFrame, resid: str = "e", key: str = "_id") -> DataFrame:
    """Normal probability plot points: ordered residuals against normal quantiles at
    Filliben's plotting positions; global ranks come from ``rank_within`` (no single
    task)."""
    ranked = global_row_number(df.select(resid, key), [F.asc_nulls_first(resid), F.asc(key)])
    n = F.col("_n").cast("double")
    i = F.col("_rn").cast("double")
    m = (F.when(F.col("_rn") == 1, 1 - F.pow(F.lit(0.5), 1 / n))
          .when(F.col("_rn") == F.col("_n"), F.pow(F.lit(0.5), 1 / n))
          .otherwise((i - 0.3175) / (n + 0.365)))
    return ranked.select(F.col("_rn").alias("i"), normal_quantile(m).alias("theoretical"),
                         F.col(resid).alias("ordered"))


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the Q-Q points and its correlation."""
    return points.agg(F.regr_slope("ordered", "theoretical").alias("slope"),
                      F.regr_intercept("ordered", "theoretical").alias("intercept"),
                      F.corr("ordered", "theoretical").alias("r"))


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 100) -> DataFrame:
    """Point set of a scatter (e.g. residual vs predicted, predicted vs actual) as counts
    on a bins x bins grid between the observed ranges: bounded output at any size."""
    rng = df.agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))
    d = attach(df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()), rng)

    def cell(c, lo, hi):
        w = F.nullif((F.col(hi) - F.col(lo)) / F.lit(float(bins)), F.lit(0.0))
        return F.coalesce(F.least(F.floor((F.col(c) - F.col(lo)) / w).cast("int"), F.lit(bins - 1)), F.lit(0))

    return (d.select(cell(x, "_x0", "_x1").alias("x_bin"), cell(y, "_y0", "_y1").alias("y_bin"),
                     "_x0", "_x1", "_y0", "_y1")
            .groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"),
                                     F.first("_x0").alias("x_min"), F.first("_x1").alias("x_max"),
                                     F.first("_y0").alias("y_min"), F.first("_y1").alias("y_max"))
            .orderBy("x_bin", "y_bin"))
