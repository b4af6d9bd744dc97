"""Exact quantiles by narrowing value ranges, without a sort and without a copy of the rows.

Finding the value of a rank needs no order of all rows, only counts. A first pass counts
the rows by order of magnitude (sign and power of two), with the least and the greatest
value of each bin. The bin that holds a sought rank is known from running counts; if its
least and greatest values are equal, the rank's value is found, else the next pass cuts the
range between them into equal bins and counts again. Ranges shrink at least 4,096-fold a
pass from within a factor of two, so a double is found after five more passes at most, and
ties or few distinct values end it sooner.

What a pass shuffles are counts, combined in the tasks: bins per group and open range, not
rows. A hot group or a tied value of any size is one number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabline.operators.ranking import same_groups
from cabline.session import materialize

#: Bins that one pass cuts an open range into.
BINS = 4_096


def magnitude(v: Column) -> Column:
    """Integer that never falls when v grows: sign and power of two; NaN comes last."""
    power = F.least(F.greatest(F.floor(F.log2(F.abs(v))), F.lit(-1_080)), F.lit(1_030)) + 1_100
    return F.when(F.isnan(v), 9_999).when(v == 0, 0).otherwise(F.signum(v).cast("int") * power).cast("int")


def _within(rows: DataFrame, ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that lie in an open range of their group, with that range."""
    named = ranges.withColumnsRenamed({c: f"_r_{c}" for c in by})
    inside = (rows["_v"] >= named["_lo"]) & (rows["_v"] <= named["_hi"])
    if not by:                                    # at most two ranges a probability
        return rows.join(F.broadcast(named), inside)
    return rows.join(named, same_groups(rows, named, by, inside)).drop(*[f"_r_{c}" for c in by])


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), name: str = "q") -> DataFrame:
    """Exact linearly interpolated percentiles (``percentile`` / ``quantile_cont``
    semantics) of ``value`` per ``by`` group: one row per group with ``name`` as
    ``array<double>`` in ``probs`` order and ``_n`` (non-NULL count).

    NULL groups are groups; NULL values are left out; NaN is the greatest value. The rows
    are read once a pass, so hand in a stored frame where they are costly to compute.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    extent = F.count(F.lit(1)).alias("_cnt"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    bins = rows.groupBy(*by, magnitude(F.col("_v")).alias("_bin")).agg(*extent)
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    state = (bins.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
             .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*by)))
             .select("*", each.alias("w")).withColumn("_h", (F.col("_n") - 1) * F.col("w.p"))
             .withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))))
             .where("_off <= _r AND _r < _off + _cnt")
             .select(*by, "_n", F.col("w.i").alias("_i"), "_h", "_r", "_off", "_lo", "_hi"))
    found = None
    while True:
        state = materialize(state, "ranges")       # a few rows a group
        known = state.where("_lo = _hi").select(*by, "_n", "_i", "_h", "_r", F.col("_lo").alias("_v"))
        found = known if found is None else found.unionByName(known)
        left = state.where("_lo <> _hi")
        if left.isEmpty():
            break
        state = _narrowed(rows, left, by, extent)
    at = F.max(F.struct("_r", "_v")), F.min(F.struct("_r", "_v"))
    points = (found.groupBy(*by, "_n", "_i", "_h").agg(at[0].alias("b"), at[1].alias("a"))
              .withColumn("_q", F.when(F.col("a._v") == F.col("b._v"), F.col("a._v"))      # also where both are infinite
                          .otherwise(F.col("a._v") + (F.col("b._v") - F.col("a._v")) * (F.col("_h") - F.floor("_h")))))
    return (points.groupBy(*by, "_n").agg(F.sort_array(F.collect_list(F.struct("_i", "_q"))).alias("_qs"))
            .select(*by, F.col("_qs._q").alias(name), "_n"))


def _narrowed(rows: DataFrame, left: DataFrame, by: list[str], extent) -> DataFrame:
    """The open ranks with the bin of their range that holds them."""
    ranges = left.select(*by, "_off", "_lo", "_hi").distinct()
    low, high = F.col("_from"), F.col("_to")
    cut = F.least(F.floor((F.col("_v") - low) / (high - low) * BINS), F.lit(BINS - 1))
    inside = _within(rows, ranges, by).withColumnsRenamed({"_lo": "_from", "_hi": "_to"})
    bins = inside.groupBy(*by, "_off", cut.alias("_bin")).agg(*extent)
    before = Window.partitionBy(*by, "_off").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_start", F.col("_off") + F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    bins = bins.withColumnsRenamed({"_off": "_range", **{c: f"_r_{c}" for c in by}})
    old = left.drop("_lo", "_hi")
    mine = (old["_off"] == bins["_range"]) & (old["_r"] >= bins["_start"]) & (old["_r"] < bins["_start"] + bins["_cnt"])
    return (old.join(bins, same_groups(old, bins, by, mine))
            .select(*by, "_n", "_i", "_h", "_r", F.col("_start").alias("_off"), "_lo", "_hi"))


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_percentiles(df, value, [0.5], by, name="_m").select(*list(by), F.col("_m")[0].alias(name))
