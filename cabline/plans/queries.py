"""Registered queries: one per operator group, each reading the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL`` (DuckDB).
Every computed column is aliased to the same name on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline import schemas
from cabline.operators import diagnose as DG
from cabline.operators import features as FT
from cabline.operators import linear as LN
from cabline.operators import profile
from cabline.operators import rollup as RU
from cabline.operators import sample as SM
from cabline.operators import sparse as SP
from cabline.operators.gram import collect_grams
from cabline.operators.wide import build_wide
from cabline.operators.ranking import global_row_number
from cabline.plans import bindings as B
from cabline.plans import ingest as MI
from cabline.plans import model as MJ
from cabline.plans import oracle_sql as O
from cabline.session import materialize, scratch_path
from cabline.sources import ledger as LG
from cabline.sources import sinks
from cabline.sources.conform import conform_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def wide_table(spark: SparkSession, sf_dir: str, years=None, clustered: bool = False) -> DataFrame:
    """The wide table over the bindings."""
    raw = {s: B.raw_service(spark, sf_dir, s) for s in ("yellow", "green")}
    return build_wide(raw, B.zones(spark, sf_dir), years, clustered=clustered)


# ------------------------------------------------------------------ wide table


@register("wide_build", O.over_wide("SELECT * FROM wide"))
def q_wide_build(spark, sf_dir):
    return wide_table(spark, sf_dir)


@register("wide_build_years", O.over_wide("SELECT * FROM wide WHERE source_year IN (1996, 1998)"))
def q_wide_build_years(spark, sf_dir):
    return wide_table(spark, sf_dir, years=[1996, 1998])


@register("wide_summary_service", O.over_wide("""
SELECT service_type, COUNT(*) AS filas, MIN(year) AS min_year, MAX(year) AS max_year,
       MIN(month) AS min_month, MAX(month) AS max_month
FROM wide GROUP BY service_type ORDER BY service_type"""))
def q_wide_summary_service(spark, sf_dir):
    return profile.service_summary(wide_table(spark, sf_dir))


@register("wide_summary_year", O.over_wide("""
SELECT year, service_type, COUNT(*) AS filas FROM wide GROUP BY year, service_type
ORDER BY year, service_type"""))
def q_wide_summary_year(spark, sf_dir):
    return profile.year_service_counts(wide_table(spark, sf_dir))


@register("wide_summary_range", O.over_wide("""
SELECT service_type, year, COUNT(*) AS trips, MIN(pickup_datetime) AS first_pickup,
       MAX(pickup_datetime) AS last_pickup
FROM wide GROUP BY service_type, year ORDER BY service_type, year"""))
def q_wide_summary_range(spark, sf_dir):
    return profile.service_year_ranges(wide_table(spark, sf_dir))


# ------------------------------------------------------------ ingest side


def _drift_sql(service: str) -> str:
    prefix = "tpep" if service == "yellow" else "lpep"
    names = {f"{prefix}_pickup_datetime": "pickup_datetime AS {c}", f"{prefix}_dropoff_datetime": "dropoff_datetime AS {c}",
             "passenger_count": "CASE WHEN source_year IN (1998, 1999) AND passenger_count = 0 THEN NULL"
                                " ELSE passenger_count END AS passenger_count"}
    cols = ", ".join(names.get(c, c).format(c=c) for c in schemas.raw_with_lineage(service).fieldNames())
    return f"""
WITH trips AS ({B.TRIPS_SQL})
SELECT {cols}
FROM trips WHERE service_type = '{service}'"""


def _conform_drift(spark, sf_dir, service):
    target = schemas.raw_with_lineage(service)
    parts = [conform_schema(g, target, tolerant=True) for g in B.drifted_generations(spark, sf_dir, service)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("conform_drift", _drift_sql("yellow"))
def q_conform_drift(spark, sf_dir):
    return _conform_drift(spark, sf_dir, "yellow")


@register("conform_drift_green", _drift_sql("green"))
def q_conform_drift_green(spark, sf_dir):
    return _conform_drift(spark, sf_dir, "green")


@register("partition_replace", O.over_wide("""
SELECT source_year, service_type,
       CASE WHEN source_year = 1996 AND service_type = 'yellow' THEN 'rerun' ELSE run_id END AS run_id,
       COUNT(*) AS rows
FROM wide WHERE NOT (source_year = 1998 AND service_type = 'green') GROUP BY 1, 2, 3"""))
def q_partition_replace(spark, sf_dir):
    path = scratch_path(spark, "wide")
    wide = wide_table(spark, sf_dir, clustered=True)
    sinks.full_rebuild(wide, path, overwrite=True, clustered=True)
    # existing partitions are skipped without overwrite ...
    sinks.partition_replace(spark, wide, path, [(1996, "yellow"), (1997, "green")], overwrite=False, clustered=True)
    # ... and replaced, alone, with it
    rerun = wide.withColumn("run_id", F.lit("rerun"))
    sinks.partition_replace(spark, rerun, path, [(1996, "yellow")], overwrite=True, clustered=True)
    # a partition whose source rows are gone is emptied
    less = wide.where("NOT (source_year = 1998 AND service_type = 'green')")
    sinks.partition_replace(spark, less, path, [(1998, "green")], overwrite=True, clustered=True)
    return (spark.read.parquet(path).groupBy("source_year", "service_type", "run_id")
            .agg(F.count(F.lit(1)).alias("rows")))


@register("partition_counts", O.over_wide(
    "SELECT source_year, service_type, COUNT(*) AS rows FROM wide GROUP BY source_year, service_type"))
def q_partition_counts(spark, sf_dir):
    """Rows per partition of the stored wide table, from its files' footers."""
    path = scratch_path(spark, "wide")
    sinks.full_rebuild(wide_table(spark, sf_dir, clustered=True), path, overwrite=True, clustered=True)
    return sinks.existing_partitions(spark, path)


@register("wide_catalog", O.over_wide("""
SELECT source_year, service_type, COUNT(*) AS rows, round(SUM(total_amount), 2) AS total FROM wide
WHERE NOT (source_year = 1998 AND service_type = 'green') GROUP BY source_year, service_type"""))
def q_wide_catalog(spark, sf_dir):
    """The wide table as a catalog table: created if missing, partitions registered after a
    rebuild and after one was emptied, read by name."""
    path = scratch_path(spark, "wide")
    name = f"cabline_{path.rsplit('-', 1)[1]}.wide"
    wide = wide_table(spark, sf_dir, clustered=True)
    for _ in range(2):                       # the second call finds it
        sinks.ensure_table(spark, name, wide.schema, path)
    sinks.full_rebuild(wide, path, overwrite=True, clustered=True)
    sinks.register_partitions(spark, name, path)
    less = wide.where("NOT (source_year = 1998 AND service_type = 'green')")
    sinks.partition_replace(spark, less, path, [(1998, "green")], overwrite=True, clustered=True)
    sinks.register_partitions(spark, name, path)
    return spark.table(name).groupBy("source_year", "service_type").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("total_amount"), 2).alias("total"))


@register("wide_summary_incremental", O.over_wide("""
SELECT service_type, year, COUNT(*) AS trips, MIN(pickup_datetime) AS first_pickup, MAX(pickup_datetime) AS last_pickup,
       COUNT(DISTINCT vendor_id) AS n_vendor_id, COUNT(DISTINCT payment_type) AS n_payment_type
FROM wide WHERE NOT (source_year = 1998 AND service_type = 'green') AND NOT (source_year = 1996 AND service_type = 'yellow' AND month > 6)
GROUP BY service_type, year"""))
def q_wide_summary_incremental(spark, sf_dir):
    """Per-partition summary of the stored wide table, refreshed only for the partitions that
    were replaced or emptied after it was made."""
    path, summary = scratch_path(spark, "wide"), scratch_path(spark, "summary")
    wide = wide_table(spark, sf_dir, clustered=True)
    sinks.full_rebuild(wide, path, overwrite=True, clustered=True)
    RU.refresh(spark, path, summary, [tuple(r) for r in sinks.existing_partitions(spark, path).select(*sinks.WIDE_PARTITIONS).collect()])
    touched = [(1996, "yellow"), (1998, "green")]
    fewer = wide.where("(source_year = 1996 AND service_type = 'yellow' AND month <= 6)")
    sinks.partition_replace(spark, fewer, path, touched, overwrite=True, clustered=True)
    RU.refresh(spark, path, summary, touched)
    return RU.service_year_ranges(spark.read.parquet(summary), ["vendor_id", "payment_type"])


@register("ingest_backfill", f"""
WITH trips AS ({B.TRIPS_SQL}),
grid AS (
  SELECT s.service, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month
  FROM (VALUES ('yellow'), ('green')) s(service),
       (SELECT unnest(generate_series(MIN(source_year), MAX(source_year))) AS year FROM trips) y,
       (SELECT unnest(generate_series(1, 12)) AS month) m),
c AS (SELECT service_type AS service, source_year AS year, source_month AS month, COUNT(*) AS n FROM trips GROUP BY 1, 2, 3)
SELECT g.service, g.year, g.month, CASE WHEN n IS NULL THEN 'ERROR' ELSE 'OK' END AS status,
       CAST(CASE WHEN n IS NULL THEN 2 ELSE 1 END AS BIGINT) AS attempts, CAST(COALESCE(n, 0) AS BIGINT) AS ledger_rows, CAST(COALESCE(n, 0) AS BIGINT) AS landed_rows
FROM grid g LEFT JOIN c ON c.service = g.service AND c.year = g.year AND c.month = g.month""")
def q_ingest_backfill(spark, sf_dir):
    """All months landed from their files, eight at a time, then the job run again: a month
    without a file fails alone and is tried twice, a landed one is not landed again."""
    base = scratch_path(spark, "ingest")
    B.landing_files(spark, sf_dir, f"{base}/files")
    span = B.trips(spark, sf_dir).agg(F.min("source_year"), F.max("source_year")).first()
    for tag in ("run1", "run2"):
        MI.ingest(spark, f"{base}/files", f"{base}/raw", f"{base}/ledger", ["yellow", "green"], range(span[0], span[1] + 1), run_tag=tag, workers=8)
    tried = LG.read_ledger(spark, f"{base}/ledger").groupBy(*LG.KEYS).agg(
        F.max("status").alias("status"), F.count(F.lit(1)).alias("attempts"), F.sum("rows").alias("ledger_rows"))
    landed = None
    for s in ("yellow", "green"):
        one = spark.read.parquet(f"{base}/raw/{s}").groupBy(F.lit(s).alias("service"), F.col("source_year").alias("year"), F.col("source_month").alias("month"))
        one = one.agg(F.count(F.lit(1)).alias("landed_rows"))
        landed = one if landed is None else landed.unionByName(one)
    return tried.join(landed, LG.KEYS, "left").withColumn("landed_rows", F.coalesce("landed_rows", F.lit(0)))


@register("ledger_compacted", f"""
WITH trips AS ({B.TRIPS_SQL}), {B.LEDGER_SQL}
SELECT service, status, COUNT(*) AS n_months, CAST(SUM(rows) AS BIGINT) AS total_rows
FROM ledger GROUP BY service, status""")
def q_ledger_compacted(spark, sf_dir):
    """Summary of a ledger that was appended to by year and compacted in between."""
    path = scratch_path(spark, "ledger")
    attempts = B.ledger_attempts(spark, sf_dir).select("service", "year", "month", "status", "rows", "run_tag", "error").collect()   # bounded by months
    for i, year in enumerate(sorted({r["year"] for r in attempts})):
        LG.append_attempts(spark, path, [tuple(r) for r in attempts if r["year"] == year])
        if i % 3 == 2:
            LG.compact_ledger(spark, path)
    return LG.ledger_summary(LG.read_ledger(spark, path))


@register("ingest_worklist", f"""
WITH trips AS ({B.TRIPS_SQL}), {B.LEDGER_SQL},
grid AS (
  SELECT s.service, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month
  FROM (VALUES ('yellow'), ('green')) s(service),
       (SELECT unnest(generate_series(MIN(source_year), MAX(source_year))) AS year FROM trips) y,
       (SELECT unnest(generate_series(1, 12)) AS month) m)
SELECT g.service, g.year, g.month FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.status = 'OK' AND l.service = g.service
                  AND l.year = g.year AND l.month = g.month)""")
def q_ingest_worklist(spark, sf_dir):
    t = B.trips(spark, sf_dir)
    wanted = (t.agg(F.explode(F.sequence(F.min("source_year"), F.max("source_year"))).alias("year"))
              .withColumn("year", F.col("year").cast("int"))
              .withColumn("service", F.explode(F.array(F.lit("yellow"), F.lit("green"))))
              .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))))
    return LG.pending_months(wanted.select("service", "year", "month"), B.ledger_attempts(spark, sf_dir))


@register("ledger_summary", f"""
WITH trips AS ({B.TRIPS_SQL}), {B.LEDGER_SQL}
SELECT service, status, COUNT(*) AS n_months, CAST(SUM(rows) AS BIGINT) AS total_rows
FROM ledger GROUP BY service, status ORDER BY service, status""")
def q_ledger_summary(spark, sf_dir):
    return LG.ledger_summary(B.ledger_attempts(spark, sf_dir))


@register("ledger_error_rate", f"""
WITH trips AS ({B.TRIPS_SQL}), {B.LEDGER_SQL},
p AS (SELECT service, COUNT(*) FILTER (WHERE status = 'OK') AS "OK",
             COUNT(*) FILTER (WHERE status = 'ERROR') AS "ERROR" FROM ledger GROUP BY service)
SELECT service, "OK", "ERROR", "OK" + "ERROR" AS total_months,
       round(100.0 * "ERROR" / NULLIF("OK" + "ERROR", 0), 1) AS error_pct
FROM p ORDER BY service""")
def q_ledger_error_rate(spark, sf_dir):
    return LG.ledger_error_rate(B.ledger_attempts(spark, sf_dir))


# ------------------------------------------------------------ modelling sample


def filtered_table(spark, sf_dir):
    """Every row that passes the quality filter, written once in the shared folder: the
    wide table is virtual here (recomputed from the bindings' joins), and profiling,
    features, scoring and diagnostics read it several times."""
    return materialize(SM.quality_filter(wide_table(spark, sf_dir)).select(*schemas.SAMPLE_COLUMNS), "filtered")


@register("quality_filter", O.over_filt("SELECT * FROM filt"))
def q_quality_filter(spark, sf_dir):
    return SM.quality_filter(wide_table(spark, sf_dir)).select(*schemas.SAMPLE_COLUMNS)


@register("stratified_sample", O.over_sample("SELECT * FROM sample"))
def q_stratified_sample(spark, sf_dir):
    filt = SM.quality_filter(wide_table(spark, sf_dir)).select(*schemas.SAMPLE_COLUMNS)
    return SM.stratified_time_sample(filt, O.ROWS_PER_YEAR)


@register("basic_quality_filter", O.over_wide("SELECT * FROM wide WHERE total_amount > 0 AND trip_distance > 0"))
def q_basic_quality_filter(spark, sf_dir):
    return SM.basic_quality_filter(wide_table(spark, sf_dir))


# ------------------------------------------------------------ exploration

CATEGORICALS = ["service_type", "vendor_id", "rate_code_id", "payment_type", "pu_borough", "pu_zone"]


def _hist_sql(expr: str, bins: int = 50) -> str:
    return O.over_filt(f"""
SELECT g.bin, round(r.lo + (g.bin - 1) * ((r.hi - r.lo) / {bins}.0), 6) AS lo,
       round(r.lo + g.bin * ((r.hi - r.lo) / {bins}.0), 6) AS hi, COALESCE(c.cnt, 0) AS count
FROM (SELECT CAST(unnest(generate_series(1, {bins})) AS INTEGER) AS bin) g, r
LEFT JOIN c ON c.bin = g.bin ORDER BY g.bin""", f"""x AS (SELECT {expr} AS x FROM filt WHERE {expr} IS NOT NULL),
r AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM x),
c AS (SELECT COALESCE(LEAST(CAST(floor((x.x - r.lo) / NULLIF((r.hi - r.lo) / {bins}.0, 0)) AS INTEGER) + 1, {bins}), 1)
             AS bin, COUNT(*) AS cnt FROM x, r GROUP BY 1)""")


@register("describe_target", O.over_filt("""
SELECT COUNT(total_amount) AS count, round(AVG(total_amount), 6) AS mean,
       round(stddev_samp(total_amount), 6) AS std, round(MIN(total_amount), 6) AS min,
       round(quantile_cont(total_amount, 0.25), 6) AS p25, round(quantile_cont(total_amount, 0.5), 6) AS p50,
       round(quantile_cont(total_amount, 0.75), 6) AS p75, round(MAX(total_amount), 6) AS max
FROM filt"""))
def q_describe_target(spark, sf_dir):
    return profile.describe(filtered_table(spark, sf_dir), "total_amount")


@register("null_profile", O.over_filt(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM filt" for c in schemas.SAMPLE_COLUMNS)
    + ") WHERE nulls > 0 ORDER BY nulls DESC, column_name"))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(filtered_table(spark, sf_dir))


@register("cardinality", O.over_filt(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_unique FROM filt"
                       for c in CATEGORICALS) + " ORDER BY column_name"))
def q_cardinality(spark, sf_dir):
    return profile.cardinality(filtered_table(spark, sf_dir), CATEGORICALS)


@register("topk_values", O.over_filt("""
SELECT pu_zone, COUNT(*) AS n FROM filt WHERE pu_zone IS NOT NULL
GROUP BY pu_zone ORDER BY n DESC, pu_zone LIMIT 20"""))
def q_topk_values(spark, sf_dir):
    return profile.top_values(filtered_table(spark, sf_dir), "pu_zone", 20)


@register("hist_raw", _hist_sql("total_amount"))
def q_hist_raw(spark, sf_dir):
    return profile.histogram(filtered_table(spark, sf_dir), F.col("total_amount"), 50)


@register("hist_log", _hist_sql("ln(1 + total_amount)"))
def q_hist_log(spark, sf_dir):
    return profile.histogram(filtered_table(spark, sf_dir), F.log1p("total_amount"), 50)


@register("rows_per_month", O.over_filt("""
SELECT year, month, COUNT(*) AS rows FROM filt GROUP BY year, month ORDER BY year, month"""))
def q_rows_per_month(spark, sf_dir):
    return profile.rows_per(filtered_table(spark, sf_dir), ["year", "month"])


# ------------------------------------------------------------ features and models


TWO = ("trip_distance", "base_fare_components")
GD_INIT = tuple(float(v) for v in LN.initial_weights(2, 42))


def feature_frame(spark, sf_dir):
    s = FT.create_features(filtered_table(spark, sf_dir))
    return FT.split_by_month(FT.prepare_features(s))


def two_feature_design(spark, sf_dir):
    """Scaled trip_distance and base_fare_components (train statistics), target y."""
    f = feature_frame(spark, sf_dir)
    pre = FT.Preprocessor(numeric=TWO, categorical=(), binary=(), interaction=None).fit(f.where("split = 'train'"))
    return pre.transform(f.withColumn("y", F.col(FT.TARGET)), keep=["split", "y", "pickup_datetime"])


def _fit_two(spark, sf_dir, solver):
    d = two_feature_design(spark, sf_dir)
    g = collect_grams(d.where("split = 'train'"), 2)["all"]
    return d, solver(g)


def _weights_df(spark, fit):
    rows = [(n, float(round(w, 6))) for n, w in zip(TWO, fit.weights)] + [("bias", float(round(fit.bias, 6)))]
    return spark.createDataFrame(rows, "feature string, weight double")


@register("feature_flags", O.over_filt("""
SELECT CAST((pickup_hour BETWEEN 7 AND 9) OR (pickup_hour BETWEEN 17 AND 19) AS INTEGER) AS is_rush_hour,
       CAST(pickup_dow IN (5, 6) AS INTEGER) AS is_weekend,
       CAST(pickup_hour >= 20 OR pickup_hour <= 5 AS INTEGER) AS is_night, COUNT(*) AS n
FROM filt GROUP BY 1, 2, 3"""))
def q_feature_flags(spark, sf_dir):
    f = FT.create_features(filtered_table(spark, sf_dir))
    return f.groupBy(*[F.col(c).cast("int").alias(c) for c in FT.BINARY]).agg(F.count(F.lit(1)).alias("n"))


@register("topk_other", O.over_filt("""
SELECT CASE WHEN pu_zone IN (SELECT pu_zone FROM top) THEN pu_zone ELSE 'Other' END AS pu_zone_processed,
       COUNT(*) AS n FROM filt GROUP BY 1""", """top AS (
  SELECT pu_zone FROM filt WHERE pu_zone IS NOT NULL GROUP BY pu_zone ORDER BY COUNT(*) DESC, pu_zone LIMIT 20)"""))
def q_topk_other(spark, sf_dir):
    f = FT.create_features(filtered_table(spark, sf_dir))
    return f.groupBy("pu_zone_processed").agg(F.count(F.lit(1)).alias("n"))


@register("fare_components", O.over_filt("""
SELECT service_type, round(AVG(fare_amount + extra + mta_tax + improvement_surcharge), 6) AS avg_base,
       round(MIN(fare_amount + extra + mta_tax + improvement_surcharge), 6) AS min_base,
       round(MAX(fare_amount + extra + mta_tax + improvement_surcharge), 6) AS max_base
FROM filt GROUP BY service_type"""))
def q_fare_components(spark, sf_dir):
    f = FT.create_features(filtered_table(spark, sf_dir))
    b = F.col("base_fare_components")
    return f.groupBy("service_type").agg(F.round(F.avg(b), 6).alias("avg_base"), F.round(F.min(b), 6).alias("min_base"),
                                         F.round(F.max(b), 6).alias("max_base"))


@register("split_months", O.over_features("SELECT month, split, COUNT(*) AS n FROM feat GROUP BY month, split"))
def q_split_months(spark, sf_dir):
    f = feature_frame(spark, sf_dir)
    return f.groupBy(F.col("month").cast("int").alias("month"), "split").agg(F.count(F.lit(1)).alias("n"))


@register("split_time_range", O.over_features("""
SELECT split, MIN(pickup_datetime) AS first_pickup, MAX(pickup_datetime) AS last_pickup, COUNT(*) AS n
FROM feat GROUP BY split"""))
def q_split_time_range(spark, sf_dir):
    return (feature_frame(spark, sf_dir).groupBy("split")
            .agg(F.min("pickup_datetime").alias("first_pickup"), F.max("pickup_datetime").alias("last_pickup"),
                 F.count(F.lit(1)).alias("n")))


@register("split_years", O.over_filt("""
SELECT year, CASE WHEN year <= 1999 THEN 'train' WHEN year = 2000 THEN 'validation' ELSE 'test' END AS split,
       COUNT(*) AS n FROM filt GROUP BY 1, 2"""))
def q_split_years(spark, sf_dir):
    return FT.split_by_years(filtered_table(spark, sf_dir)).groupBy("year", "split").agg(F.count(F.lit(1)).alias("n"))


@register("split_years_listed", O.over_filt("""
SELECT year, CASE WHEN year IN (1995, 1996) THEN 'train' WHEN year = 1998 THEN 'validation' ELSE 'test' END AS split,
       COUNT(*) AS n FROM filt WHERE year IN (1995, 1996, 1998, 2000) GROUP BY 1, 2"""))
def q_split_years_listed(spark, sf_dir):
    """Explicit lists; years in none of them are dropped."""
    f = FT.split_by_years(filtered_table(spark, sf_dir), train=[1995, 1996], val=[1998], test=[2000])
    return f.groupBy("year", "split").agg(F.count(F.lit(1)).alias("n"))


@register("impute", O.over_wide("""
SELECT column_name, strategy, value, COUNT(*) FILTER (was_null) AS filled FROM (
  SELECT 'total_amount' AS column_name, 'median' AS strategy, round((SELECT median(total_amount) FROM wide), 6) AS value,
         total_amount IS NULL AS was_null FROM wide
  UNION ALL SELECT 'vendor_id', 'most_frequent',
         (SELECT CAST(vendor_id AS DOUBLE) FROM wide WHERE vendor_id IS NOT NULL GROUP BY vendor_id ORDER BY COUNT(*) DESC, vendor_id LIMIT 1),
         vendor_id IS NULL FROM wide
  UNION ALL SELECT 'rate_code_id', 'constant', -1.0, rate_code_id IS NULL FROM wide) GROUP BY 1, 2, 3"""))
def q_impute(spark, sf_dir):
    """Median, most frequent and constant fill of columns that hold NULLs."""
    names = ["total_amount", "vendor_id", "rate_code_id"]
    wide = materialize(wide_table(spark, sf_dir).select(*names), "impute")
    rows = None
    for c, strategy, fill in (("total_amount", "median", None), ("vendor_id", "most_frequent", None), ("rate_code_id", "constant", -1)):
        marked = wide.withColumn("was_null", F.col(c).isNull())
        done = FT.Imputer([c], strategy, fill).fit(marked).transform(marked)
        one = done.agg(F.round(F.max(F.when(F.col("was_null"), F.col(c))).cast("double"), 6).alias("value"), F.count_if("was_null").alias("filled"))
        one = one.select(F.lit(c).alias("column_name"), F.lit(strategy).alias("strategy"), "value", "filled")
        rows = one if rows is None else rows.unionByName(one)
    return rows


_NUM_SQL = {
    "trip_distance": "trip_distance", "passenger_count": "passenger_count", "pickup_hour": "pickup_hour",
    "base_fare_components": "base_fare_components", "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee", "pickup_dow": "pickup_dow", "month": "month", "year": "year",
}


@register("impute_scale", O.over_features(" UNION ALL ".join(
    f"SELECT '{k}' AS feature, round(AVG(COALESCE(CAST({v} AS DOUBLE), 0)), 6) AS mean, "
    f"round(stddev_pop(COALESCE(CAST({v} AS DOUBLE), 0)), 6) AS std FROM feat WHERE split = 'train'"
    for k, v in _NUM_SQL.items())))
def q_impute_scale(spark, sf_dir):
    f = feature_frame(spark, sf_dir)
    pre = FT.Preprocessor(categorical=(), binary=(), interaction=None).fit(f.where("split = 'train'"))
    rows = [(c, float(round(pre.means[c], 6)), float(round(pre.stds[c], 6))) for c in pre.numeric]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


_CAT_SQL = {
    "service_type": "service_type", "vendor_id": "vendor_id", "rate_code_id": "rate_code_id",
    "pu_borough": "pu_borough",
}


@register("one_hot", O.over_features(" UNION ALL ".join(f"""
SELECT '{k}' AS feature, c.category, c.slot, COUNT(v.val) AS val_ones FROM
  (SELECT category, CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS slot FROM
     (SELECT DISTINCT COALESCE(CAST({e} AS VARCHAR), 'missing') AS category FROM feat WHERE split = 'train')) c
  LEFT JOIN (SELECT COALESCE(CAST({e} AS VARCHAR), 'missing') AS val FROM feat WHERE split = 'validation') v
  ON v.val = c.category GROUP BY c.category, c.slot""" for k, e in _CAT_SQL.items())))
def q_one_hot(spark, sf_dir):
    f = feature_frame(spark, sf_dir)
    cats = list(_CAT_SQL)
    pre = FT.Preprocessor(numeric=(), categorical=cats, binary=(), interaction=None).fit(f.where("split = 'train'"))
    x = pre.transform(f.where("split = 'validation'"))
    sums = x.agg(*[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(len(pre.feature_names()))]).first()
    rows, i = [], 0
    for c in cats:
        for slot, v in enumerate(pre.categories[c], start=1):
            rows.append((c, v, slot, int(sums[f"s{i}"] or 0)))
            i += 1
    return spark.createDataFrame(rows, "feature string, category string, slot int, val_ones long")


@register("interaction", O.over_features("""
SELECT round(SUM(x1), 4) AS sum_a, round(SUM(x2), 4) AS sum_b, round(SUM(x1 * x2), 4) AS sum_ab, COUNT(*) AS n
FROM d WHERE split = 'validation'"""))
def q_interaction(spark, sf_dir):
    f = feature_frame(spark, sf_dir)
    pre = FT.Preprocessor(numeric=TWO, categorical=(), binary=(), interaction=TWO).fit(f.where("split = 'train'"))
    x = pre.transform(f.where("split = 'validation'"))
    return x.agg(F.round(F.sum(F.col("x")[2]), 4).alias("sum_a"), F.round(F.sum(F.col("x")[3]), 4).alias("sum_b"),
                 F.round(F.sum(F.col("x")[4]), 4).alias("sum_ab"), F.count(F.lit(1)).alias("n"))


_GRAM_NAMES = ["one", "trip_distance", "base_fare_components", "y"]


@register("gram_matrix", O.over_features("""
SELECT i, j, round(v, 4) + 0.0 AS v FROM (
  SELECT 0 AS i, 0 AS j, n AS v FROM g UNION ALL SELECT 0, 1, s1 FROM g UNION ALL SELECT 0, 2, s2 FROM g
  UNION ALL SELECT 0, 3, sy FROM g UNION ALL SELECT 1, 1, a11 FROM g UNION ALL SELECT 1, 2, a12 FROM g
  UNION ALL SELECT 1, 3, b1 FROM g UNION ALL SELECT 2, 2, a22 FROM g UNION ALL SELECT 2, 3, b2 FROM g
  UNION ALL SELECT 3, 3, yy FROM g)"""))
def q_gram_matrix(spark, sf_dir):
    g = collect_grams(two_feature_design(spark, sf_dir).where("split = 'train'"), 2)["all"]
    full = np.zeros((4, 4))
    full[0, 0], full[0, 1:3], full[0, 3] = g.n, g.sx, g.sy
    full[1:3, 1:3], full[1:3, 3], full[3, 3] = g.xtx, g.xty, g.yty
    rows = [(i, j, float(round(full[i, j], 4)) + 0.0) for i in range(4) for j in range(i, 4)]
    return spark.createDataFrame(rows, "i int, j int, v double")


# ------------------------------------------------- wide designs (one column per pickup day)


def wide_design(spark, sf_dir, categorical=("pickup_day",)):
    """Sparse rows of the two scaled numerics and one column per training category."""
    f = feature_frame(spark, sf_dir).withColumn("pickup_day", F.date_format("pickup_datetime", "yyyy-MM-dd"))
    pre = SP.SparsePreprocessor(numeric=TWO, categorical=categorical, binary=(), interaction=None).fit(f.where("split = 'train'"))
    return pre, materialize(pre.transform(f.withColumn("y", F.col(FT.TARGET)), keep=["split", "y"]), "sparse")


@register("sparse_gram", O.over_features("""
SELECT a.name AS a, b.name AS b, round(SUM(a.v * b.v), 3) + 0.0 AS v
FROM e a JOIN e b ON a.rid = b.rid AND a.ord <= b.ord GROUP BY a.name, b.name""", O.WIDE_ENTRIES))
def q_sparse_gram(spark, sf_dir):
    """All non-zero entries of Z'Z, Z = [1, two numerics, a column per pickup day and zone, y]."""
    pre, rows = wide_design(spark, sf_dir, ("pickup_day", "pu_zone"))
    names = pre.names(spark).select((F.col("place") + 1).alias("place"), "name")
    names = names.unionByName(spark.createDataFrame([(0, "one"), (pre.width + 1, "y")], "place int, name string"))
    a, b = (names.select(F.col("place").alias(k), F.col("name").alias(n)) for k, n in (("i", "a"), ("j", "b")))
    pairs = SP.pair_gram(rows.where("split = 'train'"), pre.width)
    return pairs.join(a, "i").join(b, "j").select("a", "b", (F.round("v", 3) + F.lit(0.0)).alias("v"))


def _wide_ridge(spark, sf_dir):
    pre, rows = wide_design(spark, sf_dir)
    return pre, rows, SP.ridge_cg(SP.statistics(rows.where("split = 'train'"), pre.width), [1.0])[0]


@register("sparse_ridge", O.over_features("""
SELECT feature, round(weight, 3) + 0.0 AS weight FROM (
  SELECT 'trip_distance' AS feature, w1 AS weight FROM fw UNION ALL SELECT 'base_fare_components', w2 FROM fw
  UNION ALL SELECT 'pickup_day=' || day, weight FROM dayw)""", O.wide_ridge_ctes(1.0)))
def q_sparse_ridge(spark, sf_dir):
    """Ridge on the wide design by conjugate gradients; a row per column of the design."""
    pre, _, fit = _wide_ridge(spark, sf_dir)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(fit.weights)], "place int, weight double")
    return pre.names(spark).join(weights, "place").select(F.col("name").alias("feature"), (F.round("weight", 3) + F.lit(0.0)).alias("weight"))


@register("sparse_score", O.over_features("""
SELECT split, COUNT(*) AS n, round(sqrt(AVG(e * e)), 5) AS rmse, round(AVG(abs(e)), 5) AS mae, round(1 - SUM(e * e) / (COUNT(*) * var_pop(y)), 5) AS r2
FROM (SELECT d.split, d.y, d.y - fw.w1 * d.x1 - fw.w2 * d.x2 - COALESCE(dayw.weight, 0) AS e
      FROM dated d CROSS JOIN fw LEFT JOIN dayw ON dayw.day = d.day) GROUP BY split""", O.wide_ridge_ctes(1.0)))
def q_sparse_score(spark, sf_dir):
    """Scores of the wide ridge fit per split, one pass over the sparse rows of each."""
    _, rows, fit = _wide_ridge(spark, sf_dir)
    out = None
    for split in ("train", "validation", "test"):
        one = SP.score_sparse(rows.where(F.col("split") == split), [fit]).select(
            F.lit(split).alias("split"), "n", *[F.round(c, 5).alias(c) for c in ("rmse", "mae", "r2")])
        out = one if out is None else out.unionByName(one)
    return out


@register("ridge", O.over_features(O.WEIGHTS_BODY, O.ridge_cte(1.0)))
def q_ridge(spark, sf_dir):
    return _weights_df(spark, _fit_two(spark, sf_dir, lambda g: LN.ridge(g, 1.0))[1])


@register("lasso", O.over_features(O.WEIGHTS_BODY, O.cd_cte(0.1, 0.0)))
def q_lasso(spark, sf_dir):
    return _weights_df(spark, _fit_two(spark, sf_dir, lambda g: LN.lasso(g, 0.1))[1])


@register("elastic_net", O.over_features(O.WEIGHTS_BODY, O.cd_cte(0.1 * 0.5, 0.1 * 0.5)))
def q_elastic_net(spark, sf_dir):
    return _weights_df(spark, _fit_two(spark, sf_dir, lambda g: LN.elastic_net(g, 0.1, 0.5))[1])


@register("gradient_descent", O.over_features(O.WEIGHTS_BODY, O.gd_cte(GD_INIT)))
def q_gradient_descent(spark, sf_dir):
    return _weights_df(spark, _fit_two(spark, sf_dir, lambda g: LN.gradient_descent(g, 0.01, 1000, 1e-4, 0.0))[1])


def _ridge_residuals(spark, sf_dir, split):
    d, fit = _fit_two(spark, sf_dir, lambda g: LN.ridge(g, 1.0))
    return d.where(F.col("split") == split).select("y", (F.col("y") - LN.predict(fit)).alias("e"), "pickup_datetime")


_SCORE_SQL = """round(sqrt(AVG(e * e)), 6) AS rmse, round(AVG(abs(e)), 6) AS mae,
       round(1 - SUM(e * e) / (COUNT(*) * var_pop(y)), 6) AS r2"""


@register("metrics", O.over_features(f"SELECT {_SCORE_SQL} FROM res WHERE split = 'validation'",
                                     O.ridge_cte(1.0) + ",\n" + O.RESID_CTE))
def q_metrics(spark, sf_dir):
    r = _ridge_residuals(spark, sf_dir, "validation")
    s = LN.scores(r.withColumn("_p", F.col("y") - F.col("e")), F.col("_p"))
    return s.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@register("baselines", O.over_features("""
SELECT b.model, round(sqrt(AVG((d.y - b.p) * (d.y - b.p))), 6) AS rmse, round(AVG(abs(d.y - b.p)), 6) AS mae,
       round(1 - SUM((d.y - b.p) * (d.y - b.p)) / (COUNT(*) * var_pop(d.y)), 6) AS r2
FROM d, base b WHERE d.split = 'validation' GROUP BY b.model""", """base AS (
  SELECT 'Baseline (Mean)' AS model, AVG(y) AS p FROM d WHERE split = 'train' UNION ALL
  SELECT 'Baseline (Median)', quantile_cont(y, 0.5) FROM d WHERE split = 'train')"""))
def q_baselines(spark, sf_dir):
    d = two_feature_design(spark, sf_dir)
    mean, med = DG.baseline_predictions(d.where("split = 'train'"))
    val = d.where("split = 'validation'")
    out = []
    for name, p in (("Baseline (Mean)", mean), ("Baseline (Median)", med)):
        s = LN.scores(val, F.lit(p)).first()
        out.append((name, float(round(s["rmse"], 6)), float(round(s["mae"], 6)), float(round(s["r2"], 6))))
    return spark.createDataFrame(out, "model string, rmse double, mae double, r2 double")


@register("residual_stats", O.over_features("""
SELECT round(AVG(abs(e)), 6) AS mae, round(stddev_pop(e), 6) AS std, round(median(abs(e)), 6) AS median_abs,
       round(AVG(CASE WHEN abs(e) < 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_lt_2,
       round(AVG(CASE WHEN abs(e) < 5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_lt_5
FROM res WHERE split = 'test'""", O.ridge_cte(1.0) + ",\n" + O.RESID_CTE))
def q_residual_stats(spark, sf_dir):
    return DG.residual_stats(_ridge_residuals(spark, sf_dir, "test"))


@register("abs_error_percentiles", O.over_features("""
SELECT round(quantile_cont(abs(e), 0.5), 6) AS p50, round(quantile_cont(abs(e), 0.8), 6) AS p80,
       round(quantile_cont(abs(e), 0.95), 6) AS p95,
       round(AVG(CASE WHEN abs(e) < 3 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_lt_3
FROM res WHERE split = 'test'""", O.ridge_cte(1.0) + ",\n" + O.RESID_CTE))
def q_abs_error_percentiles(spark, sf_dir):
    return DG.abs_error_percentiles(_ridge_residuals(spark, sf_dir, "test"))


@register("error_deciles", O.over_features("""
SELECT bucket, round(edges[bucket], 4) AS lo, round(edges[bucket + 1], 4) AS hi, round(AVG(e), 4) AS mean,
       round(stddev_samp(e), 4) AS std, COUNT(*) AS count
FROM (SELECT t.y, t.e, q.edges, GREATEST(1, len(list_filter(q.edges, lambda x: x < t.y))) AS bucket
      FROM (SELECT * FROM res WHERE split = 'test') t, q)
GROUP BY bucket, edges ORDER BY bucket""", O.ridge_cte(1.0) + ",\n" + O.RESID_CTE + """,
q AS (SELECT list_sort(list_distinct(quantile_cont(y, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
      AS edges FROM res WHERE split = 'test')"""))
def q_error_deciles(spark, sf_dir):
    return DG.error_by_quantile_bucket(_ridge_residuals(spark, sf_dir, "test"))


@register("error_price_buckets", O.over_features("""
SELECT bucket, round(AVG(e), 4) AS mean, round(stddev_samp(e), 4) AS std, COUNT(*) AS count FROM (
  SELECT e, CASE WHEN y > 0 AND y <= 10 THEN 1 WHEN y > 10 AND y <= 20 THEN 2 WHEN y > 20 AND y <= 30 THEN 3
                 WHEN y > 30 AND y <= 50 THEN 4 WHEN y > 50 AND y <= 100 THEN 5 WHEN y > 100 THEN 6 END AS bucket
  FROM res WHERE split = 'test') WHERE bucket IS NOT NULL GROUP BY bucket ORDER BY bucket""",
    O.ridge_cte(1.0) + ",\n" + O.RESID_CTE))
def q_error_price_buckets(spark, sf_dir):
    return DG.error_by_price_bucket(_ridge_residuals(spark, sf_dir, "test"))


_QQ_SQL = O.over_features(f"""
SELECT i, round({O.inv_norm_sql('m')}, 6) AS theoretical, round(e, 6) AS ordered
FROM (SELECT i, e, CASE WHEN i = 1 THEN 1.0::DOUBLE - power(0.5::DOUBLE, 1.0::DOUBLE / n)
                        WHEN i = n THEN power(0.5::DOUBLE, 1.0::DOUBLE / n)
                        ELSE (CAST(i AS DOUBLE) - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS m
      FROM (SELECT e, row_number() OVER (ORDER BY e) AS i, CAST(COUNT(*) OVER () AS DOUBLE) AS n
            FROM res WHERE split = 'test'))""", O.ridge_cte(1.0) + ",\n" + O.RESID_CTE)


@register("qq_points", _QQ_SQL)
def q_qq_points(spark, sf_dir):
    r = _ridge_residuals(spark, sf_dir, "test")
    r = r.withColumn("_key", F.xxhash64("pickup_datetime", "y", "e"))
    pts = DG.qq_points(r, "e", "_key")
    return pts.select("i", F.round("theoretical", 6).alias("theoretical"), F.round("ordered", 6).alias("ordered"))


_RES = O.ridge_cte(1.0) + ",\n" + O.RESID_CTE


def _hist_of_residuals(expr: str) -> str:
    return O.over_features(f"""
SELECT g.bin, round(r.lo + (g.bin - 1) * ((r.hi - r.lo) / 50.0), 4) AS lo,
       round(r.lo + g.bin * ((r.hi - r.lo) / 50.0), 4) AS hi, COALESCE(c.cnt, 0) AS count
FROM (SELECT CAST(unnest(generate_series(1, 50)) AS INTEGER) AS bin) g, r
LEFT JOIN c ON c.bin = g.bin ORDER BY g.bin""", _RES + f""",
x AS (SELECT {expr} AS x FROM res WHERE split = 'test'),
r AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM x),
c AS (SELECT LEAST(CAST(floor((x.x - r.lo) / ((r.hi - r.lo) / 50.0)) AS INTEGER) + 1, 50) AS bin, COUNT(*) AS cnt FROM x, r GROUP BY 1)""")


@register("hist_residual", _hist_of_residuals("e"))
def q_hist_residual(spark, sf_dir):
    return profile.histogram(materialize(_ridge_residuals(spark, sf_dir, "test"), "residuals"), F.col("e"), 50, 4)


@register("hist_abs_error", _hist_of_residuals("abs(e)"))
def q_hist_abs_error(spark, sf_dir):
    return profile.histogram(materialize(_ridge_residuals(spark, sf_dir, "test"), "residuals"), F.abs("e"), 50, 4)


@register("qq_line", O.over_features(f"""
SELECT round(regr_slope(e, t), 5) AS slope, round(regr_intercept(e, t), 5) AS intercept, round(corr(e, t), 5) AS r
FROM (SELECT e, {O.inv_norm_sql('m')} AS t FROM (
  SELECT i, e, CASE WHEN i = 1 THEN 1.0::DOUBLE - power(0.5::DOUBLE, 1.0::DOUBLE / n)
                    WHEN i = n THEN power(0.5::DOUBLE, 1.0::DOUBLE / n)
                    ELSE (CAST(i AS DOUBLE) - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS m
  FROM (SELECT e, row_number() OVER (ORDER BY e) AS i, CAST(COUNT(*) OVER () AS DOUBLE) AS n FROM res WHERE split = 'test')))""", _RES))
def q_qq_line(spark, sf_dir):
    r = _ridge_residuals(spark, sf_dir, "test").withColumn("_key", F.xxhash64("pickup_datetime", "y", "e"))
    line = DG.qq_line(DG.qq_points(r, "e", "_key"))
    return line.select(*[F.round(c, 5).alias(c) for c in ("slope", "intercept", "r")])


# ------------------------------------------------------------ full modelling job


def _run(spark, sf_dir):
    return MJ.prepare(filtered_table(spark, sf_dir))


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    return MJ.leaderboard(spark, _run(spark, sf_dir))


@register("grid_holdout")
def q_grid_holdout(spark, sf_dir):
    return MJ.grid_frame(spark, MJ.grid_holdout(_run(spark, sf_dir)), "From Scratch")


@register("grid_cv")
def q_grid_cv(spark, sf_dir):
    return MJ.grid_frame(spark, MJ.grid_cv(_run(spark, sf_dir)), "Intercept")


def _test_board(spark, sf_dir):
    run = _run(spark, sf_dir)
    return run, MJ.refit_test(spark, run, MJ.grid_holdout(run), MJ.grid_cv(run))


@register("refit_test")
def q_refit_test(spark, sf_dir):
    return _test_board(spark, sf_dir)[1]


@register("best_model")
def q_best_model(spark, sf_dir):
    return MJ.best_model(_test_board(spark, sf_dir)[1])


@register("report")
def q_report(spark, sf_dir):
    run, board = _test_board(spark, sf_dir)
    return MJ.report(spark, run, board)


def _scatter_sql(x: str, y: str) -> str:
    return O.over_features(f"""
SELECT x_bin, y_bin, COUNT(*) AS n, round(MIN(x0), 6) AS x_min, round(MIN(x1), 6) AS x_max,
       round(MIN(y0), 6) AS y_min, round(MIN(y1), 6) AS y_max
FROM (SELECT COALESCE(LEAST(CAST(floor((a - x0) / NULLIF((x1 - x0) / 50.0, 0)) AS INTEGER), 49), 0) AS x_bin,
             COALESCE(LEAST(CAST(floor((b - y0) / NULLIF((y1 - y0) / 50.0, 0)) AS INTEGER), 49), 0) AS y_bin,
             x0, x1, y0, y1
      FROM (SELECT {x} AS a, {y} AS b FROM res WHERE split = 'test') t,
           (SELECT MIN({x}) AS x0, MAX({x}) AS x1, MIN({y}) AS y0, MAX({y}) AS y1 FROM res WHERE split = 'test') r)
GROUP BY x_bin, y_bin ORDER BY x_bin, y_bin""", _RES)


def _scatter(spark, sf_dir, x, y):
    r = materialize(_ridge_residuals(spark, sf_dir, "test").withColumn("predicted", F.col("y") - F.col("e")), "residuals")
    b = DG.scatter_bins(r, x, y, 50)
    return b.select("x_bin", "y_bin", "n", *[F.round(c, 6).alias(c) for c in ("x_min", "x_max", "y_min", "y_max")])


@register("residual_scatter", _scatter_sql("y - e", "e"))
def q_residual_scatter(spark, sf_dir):
    """Residual against predicted value as counts on a 50 x 50 grid."""
    return _scatter(spark, sf_dir, "predicted", "e")


@register("actual_predicted", _scatter_sql("y", "y - e"))
def q_actual_predicted(spark, sf_dir):
    """Predicted against actual value as counts on a 50 x 50 grid."""
    return _scatter(spark, sf_dir, "y", "predicted")


# ------------------------------------------------------ two-feature boards (SQL-checked)

RIDGE_GRID = [0.01, 0.1, 1.0, 10.0]
_TWO_MODELS = [("SGD (From Scratch)", "From Scratch", "f_sgd"), ("Ridge (From Scratch)", "From Scratch", "f_ridge"),
               ("Lasso (From Scratch)", "From Scratch", "f_lasso"), ("ElasticNet (From Scratch)", "From Scratch", "f_en"),
               ("Ridge (Library)", "Library", "f_lib"), ("Baseline (Mean)", "Baseline", "f_mean"), ("Baseline (Median)", "Baseline", "f_median")]


def two_run(spark, sf_dir):
    """The modelling job's state on the two-feature design, which SQL can follow."""
    return MJ.run_of(two_feature_design(spark, sf_dir), 2)


@register("leaderboard_two", O.over_features(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT s.*, '{t}' AS type, (SELECT CAST((w1 <> 0)::INT + (w2 <> 0)::INT AS INTEGER) FROM {f}) AS n_features FROM ({O.val_score_sql(m, f)}) s"
        for m, t, f in _TWO_MODELS) + ") ORDER BY val_rmse, model",
    ",\n".join([O.gd_cte(GD_INIT, name="f_sgd"), O.ridge_cte(1.0, name="f_ridge"),
                 O.cd_cte(0.1, 0.0, name="f_lasso", rec="cd_l"), O.cd_cte(0.05, 0.05, name="f_en", rec="cd_e"),
                 O.ridge_intercept_cte("1.0::DOUBLE", "f_lib", "g"),
                 "f_mean AS (SELECT 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, AVG(y) AS b FROM d WHERE split = 'train')",
                 "f_median AS (SELECT 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, quantile_cont(y, 0.5) AS b "
                 "FROM d WHERE split = 'train')"])))
def q_leaderboard_two(spark, sf_dir):
    """The job's validation board on the two-feature design, without the comparators that
    iterate or draw batches."""
    board = MJ.leaderboard(spark, two_run(spark, sf_dir), {"Ridge": MJ.LIBRARY["Ridge"]})
    return board.select("model", "type", *[F.round(c, 6).alias(c) for c in ("val_rmse", "val_mae", "val_r2")], "n_features").orderBy("val_rmse", "model")


@register("grid_ridge_two", O.over_features(
    " UNION ALL ".join(
        f"SELECT CAST({a} AS DOUBLE) AS alpha, val_rmse FROM ({O.val_score_sql('r', f'fr{i}')})" for i, a in enumerate(RIDGE_GRID)),
    ",\n".join(O.ridge_cte(a, name=f"fr{i}") for i, a in enumerate(RIDGE_GRID))))
def q_grid_ridge_two(spark, sf_dir):
    """Ridge grid: every alpha solved from one train Gram, scored from the validation Gram."""
    d = two_feature_design(spark, sf_dir)
    grams = collect_grams(d.where("split != 'test'"), 2, "split")
    rows = [(a, float(round(LN.rmse_from_gram(grams["validation"], LN.ridge(grams["train"], a)), 6)))
            for a in RIDGE_GRID]
    return spark.createDataFrame(rows, "alpha double, val_rmse double")


# ------------------------------------------ tuning, refit, winner and report, two features

TWO_GRIDS = {"Ridge": {"alpha": RIDGE_GRID}, "Lasso": {"alpha": [0.01, 0.1, 0.5]},
             "ElasticNet": {"alpha": [0.01, 0.1, 0.5], "l1_ratio": [0.2, 0.5, 0.8]}}
TWO_CV = {"Ridge": {"alpha": RIDGE_GRID}}
TWO_GRID = [(m, c["alpha"], c.get("l1_ratio")) for m, grid in TWO_GRIDS.items() for c in MJ.combos(grid)]


def _two_tested(spark, sf_dir):
    """(job state, test board) after hold-out search, cross-validation and refit."""
    run = two_run(spark, sf_dir)
    return run, MJ.refit_test(spark, run, MJ.grid_holdout(run, TWO_GRIDS), MJ.grid_cv(run, grids=TWO_CV))


@register("grid_holdout_two", O.over_features(
    "SELECT model || ' (From Scratch)' AS model, alpha, l1_ratio, round(val_rmse, 6) AS val_rmse FROM best", O.grid_ctes(TWO_GRID)))
def q_grid_holdout_two(spark, sf_dir):
    """Winner of each family's hold-out grid, by the job's own search."""
    out = MJ.grid_frame(spark, MJ.grid_holdout(two_run(spark, sf_dir), TWO_GRIDS), "From Scratch")
    return out.select("model", F.col("params")["alpha"].alias("alpha"), F.col("params")["l1_ratio"].alias("l1_ratio"), F.round("val_rmse", 6).alias("val_rmse"))


@register("refit_test_two", O.over_features("""
SELECT model, type, alpha, l1_ratio, round(test_rmse, 6) AS test_rmse, round(test_mae, 6) AS test_mae, round(test_r2, 6) AS test_r2
FROM tested""", O.tested_ctes(TWO_GRID)))
def q_refit_test_two(spark, sf_dir):
    """The job's test board: tuned models refitted on train + validation, and baselines."""
    board = _two_tested(spark, sf_dir)[1]
    return board.select("model", "type", F.col("params")["alpha"].alias("alpha"), F.col("params")["l1_ratio"].alias("l1_ratio"),
                        *[F.round(c, 6).alias(c) for c in ("test_rmse", "test_mae", "test_r2")])


@register("best_model_two", O.over_features("""
SELECT model, type, round(test_rmse, 6) AS test_rmse FROM tested WHERE model NOT LIKE '%Baseline%' ORDER BY tested.test_rmse, model LIMIT 1""",
    O.tested_ctes(TWO_GRID)))
def q_best_model_two(spark, sf_dir):
    return MJ.best_model(_two_tested(spark, sf_dir)[1]).select("model", "type", F.round("test_rmse", 6).alias("test_rmse"))


@register("report_two", O.over_features(O.REPORT_TWO, O.tested_ctes(TWO_GRID)))
def q_report_two(spark, sf_dir):
    """The job's report: winner, scores, gain over the mean, family averages, percentiles."""
    run, board = _two_tested(spark, sf_dir)
    out = MJ.report(spark, run, board)
    digits = {"improvement_pct": 5}
    return out.select("winner", *[F.round(c, digits.get(c, 6)).alias(c) for c in out.columns[1:]])


_CV_SQL = O.over_features(f"SELECT alpha, round(cv_rmse, 6) AS cv_rmse FROM ({O.CV_CURVE})", O.FOLDS_CTE)


def _cv_curve(spark, found):
    return spark.createDataFrame([(float(c["alpha"]), float(round(m, 6))) for c, m in found["Ridge"]["curve"]], "alpha double, cv_rmse double")


@register("grid_cv_two", _CV_SQL)
def q_grid_cv_two(spark, sf_dir):
    """Time-ordered contiguous folds: Ridge with intercept over its grid, each fold's
    statistics taken off the total."""
    return _cv_curve(spark, MJ.grid_cv(two_run(spark, sf_dir), grids=TWO_CV))


@register("grid_cv_library", _CV_SQL)
def q_grid_cv_library(spark, sf_dir):
    """The same folds and grid by ``CrossValidator`` over MLlib fits."""
    return _cv_curve(spark, MJ.grid_cv_library(two_run(spark, sf_dir), TWO_CV))


# ------------------------------------------------------------ dimension load


@register("dimension_load", f"""
SELECT locationid, borough, zone, service_zone, 'load1' AS run_tag FROM ({B.ZONES_SQL})""")
def q_dimension_load(spark, sf_dir):
    """The zone dimension as a CSV with untidy headers, landed twice (full refresh)."""
    base = scratch_path(spark, "zones")
    z = B.zones(spark, sf_dir)
    z.select(F.col("locationid").alias("LocationID"), F.col("borough").alias(" Borough"), F.col("zone").alias("Zone"),
             "service_zone").write.mode("overwrite").option("header", True).csv(f"{base}/csv")
    for tag in ("load0", "load1"):
        MI.load_dimension(spark, f"{base}/csv", f"{base}/table", tag)
    return spark.read.parquet(f"{base}/table").select("locationid", "borough", "zone", "service_zone", "run_tag")
