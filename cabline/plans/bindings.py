"""Bindings of the driver's star-schema tables to trip semantics.

No trip files exist in the test environment, so a trip is a line item joined to its
order, customer (pickup zone) and supplier (dropoff zone). Line status F is the
"yellow" service, O the "green" one. A few NULLs, zero and negative amounts and
unknown codes are injected by rules on the data itself so that every edge of the
wide projection is exercised. Each binding exists twice: as DataFrame code and as
SQL text for the DuckDB oracle; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.sources.conform import conform_schema
from cabline import schemas

SERVICE_OF_STATUS = {"F": "yellow", "O": "green"}
RUN_TAG = "bind"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, service: str | None = None) -> DataFrame:
    """Trips (of one service, or all) with service-neutral column names.

    Customers join the narrow orders first, so that the wide line items are shuffled once,
    by their order, however large the customer table is.
    """
    l = table(spark, sf_dir, "lineitem")
    if service is not None:
        status = {v: k for k, v in SERVICE_OF_STATUS.items()}[service]
        l = l.where(F.col("l_linestatus") == status)   # reaches the scan as a pushed filter
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "o_orderdate", "c_nationkey")
    j = (l.join(placed, l.l_orderkey == placed.o_orderkey, "left")
          .join(s, l.l_suppkey == s.s_suppkey, "left"))
    return j.selectExpr(*[f"{expr} AS {name}" for name, expr in _TRIP_EXPRS])


# Spark SQL formulas of the trip binding (one expression per column keeps plan
# construction to one call per column).
_GROSS = ("l_extendedprice / 1000.0D + l_tax * 10.0D + 0.5D + l_extendedprice * l_discount / 1000.0D"
          " + CASE WHEN l_partkey % 10 = 0 THEN 6.55D ELSE 0.0D END + 0.3D"
          " + CASE WHEN l_returnflag = 'A' THEN 2.5D ELSE 0.0D END")
_TRIP_EXPRS = [
    ("service_type", "CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END"),
    ("VendorID", "CAST(CASE WHEN l_linenumber = 7 AND l_quantity >= 48 THEN NULL ELSE l_linenumber END AS INT)"),
    ("pickup_datetime", "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), l_linenumber * 7, 0)"),
    ("dropoff_datetime", "CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN NULL ELSE l_shipdate"
                         " + make_dt_interval(0, CAST(o_orderkey % 24 AS INT),"
                         " l_linenumber * 7 + CAST(l_partkey % 11 AS INT), 0) END"),
    ("passenger_count", "CAST(l_linenumber - 1 AS INT)"),
    ("trip_distance", "(l_quantity - 1) / 4.0D"),
    ("RatecodeID", "CAST(CASE WHEN l_returnflag = 'N' AND l_linenumber = 5 THEN NULL"
                   " ELSE round(l_discount * 100) END AS INT)"),
    ("store_and_fwd_flag", "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END"),
    ("PULocationID", "CAST(CASE WHEN l_linenumber = 6 AND l_quantity <= 2 THEN NULL ELSE c_nationkey END AS INT)"),
    ("DOLocationID", "CAST(s_nationkey AS INT)"),
    ("payment_type", "CAST(round(l_tax * 100) AS INT)"),
    ("fare_amount", "l_extendedprice / 1000.0D"),
    ("extra", "l_tax * 10.0D"),
    ("mta_tax", "0.5D"),
    ("tip_amount", "l_extendedprice * l_discount / 1000.0D"),
    ("tolls_amount", "CASE WHEN l_partkey % 10 = 0 THEN 6.55D ELSE 0.0D END"),
    ("improvement_surcharge", "0.3D"),
    ("total_amount", f"CASE WHEN l_quantity = 49 AND l_linenumber = 2 THEN CAST(NULL AS DOUBLE)"
                     f" WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN -({_GROSS})"
                     f" WHEN l_quantity = 48 AND l_linenumber = 3 THEN 0.0D ELSE {_GROSS} END"),
    ("congestion_surcharge", "CASE WHEN l_returnflag = 'A' THEN 2.5D ELSE 0.0D END"),
    ("airport_fee", "CASE WHEN s_nationkey <= 1 THEN 1.75D ELSE 0.0D END"),
    ("cbd_congestion_fee", "CASE WHEN year(o_orderdate) >= 2000 THEN 0.75D END"),
    ("trip_type", "CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END"),
    ("run_tag", f"'{RUN_TAG}'"),
    ("source_year", "CAST(year(o_orderdate) AS INT)"),
    ("source_month", "CAST(month(o_orderdate) AS INT)"),
    ("ingested_at_utc", "CAST(add_months(trunc(o_orderdate, 'MM'), 1) AS TIMESTAMP_NTZ)"),
]


def raw_service(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """The raw table of one service, with that service's column names and lineage."""
    prefix = "tpep" if service == "yellow" else "lpep"
    t = (trips(spark, sf_dir, service)
         .withColumnsRenamed({"pickup_datetime": f"{prefix}_pickup_datetime",
                              "dropoff_datetime": f"{prefix}_dropoff_datetime"}))
    target = schemas.RAW_BY_SERVICE[service]
    cols = [f.name for f in target.fields] + [n for n, _ in schemas.LINEAGE] + ["service_type"]
    return t.select(*cols)


def landing_files(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The raw trips as monthly files of the names that the ingest job reads."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for service, schema in schemas.RAW_BY_SERVICE.items():
        rows = raw_service(spark, sf_dir, service).withColumn(
            "file", F.format_string(f"{service}_tripdata_%04d-%02d.parquet", "source_year", "source_month"))
        rows.select(*schema.fieldNames(), "file").write.mode("append").partitionBy("file").parquet(base)
    fs = fs_path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(fs_path(base)):
        name = f.getPath().getName()
        if name.startswith("file="):
            fs.rename(f.getPath(), fs_path(f"{base}/{name.removeprefix('file=')}"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: one row per nation, ids shifted to 1.. so id 0 never matches."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    z = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        (F.col("n_nationkey") + 1).cast("int").alias("locationid"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("borough"),
        F.when(F.col("n_regionkey") == 1, "Yellow Zone").otherwise("Boro Zone").alias("service_zone"),
    )
    return conform_schema(z, schemas.ZONES)


# ---------------------------------------------------------------- SQL twins (DuckDB)

TRIPS_SQL = """
SELECT
  CASE WHEN l.l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS service_type,
  CAST(CASE WHEN l.l_linenumber = 7 AND l.l_quantity >= 48 THEN NULL ELSE l.l_linenumber END AS INTEGER) AS VendorID,
  o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) + to_minutes(l.l_linenumber * 7) AS pickup_datetime,
  CASE WHEN l.l_quantity = 50 AND l.l_linenumber = 1 THEN NULL
       ELSE l.l_shipdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER))
            + to_minutes(CAST(l.l_linenumber * 7 + l.l_partkey % 11 AS INTEGER)) END AS dropoff_datetime,
  CAST(l.l_linenumber - 1 AS INTEGER) AS passenger_count,
  (l.l_quantity - 1) / 4.0 AS trip_distance,
  CAST(CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 5 THEN NULL ELSE round(l.l_discount * 100) END AS INTEGER) AS RatecodeID,
  CASE WHEN l.l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(CASE WHEN l.l_linenumber = 6 AND l.l_quantity <= 2 THEN NULL ELSE c.c_nationkey END AS INTEGER) AS PULocationID,
  CAST(s.s_nationkey AS INTEGER) AS DOLocationID,
  CAST(round(l.l_tax * 100) AS INTEGER) AS payment_type,
  l.l_extendedprice / 1000.0 AS fare_amount,
  l.l_tax * 10.0 AS extra,
  0.5::DOUBLE AS mta_tax,
  l.l_extendedprice * l.l_discount / 1000.0 AS tip_amount,
  CASE WHEN l.l_partkey % 10 = 0 THEN 6.55 ELSE 0.0 END::DOUBLE AS tolls_amount,
  0.3::DOUBLE AS improvement_surcharge,
  CASE WHEN l.l_quantity = 49 AND l.l_linenumber = 2 THEN NULL
       WHEN l.l_returnflag = 'R' AND l.l_linenumber = 3 THEN -(
         l.l_extendedprice / 1000.0 + l.l_tax * 10.0 + 0.5::DOUBLE + l.l_extendedprice * l.l_discount / 1000.0
         + CASE WHEN l.l_partkey % 10 = 0 THEN 6.55 ELSE 0.0 END::DOUBLE + 0.3::DOUBLE
         + CASE WHEN l.l_returnflag = 'A' THEN 2.5 ELSE 0.0 END::DOUBLE)
       WHEN l.l_quantity = 48 AND l.l_linenumber = 3 THEN 0.0::DOUBLE
       ELSE l.l_extendedprice / 1000.0 + l.l_tax * 10.0 + 0.5::DOUBLE + l.l_extendedprice * l.l_discount / 1000.0
         + CASE WHEN l.l_partkey % 10 = 0 THEN 6.55 ELSE 0.0 END::DOUBLE + 0.3::DOUBLE
         + CASE WHEN l.l_returnflag = 'A' THEN 2.5 ELSE 0.0 END::DOUBLE END AS total_amount,
  CASE WHEN l.l_returnflag = 'A' THEN 2.5 ELSE 0.0 END::DOUBLE AS congestion_surcharge,
  CASE WHEN s.s_nationkey <= 1 THEN 1.75 ELSE 0.0 END::DOUBLE AS airport_fee,
  CASE WHEN year(o.o_orderdate) >= 2000 THEN 0.75::DOUBLE END AS cbd_congestion_fee,
  CASE WHEN l.l_returnflag = 'A' THEN 2 ELSE 1 END AS trip_type,
  'bind' AS run_tag,
  CAST(year(o.o_orderdate) AS INTEGER) AS source_year,
  CAST(month(o.o_orderdate) AS INTEGER) AS source_month,
  CAST(date_trunc('month', o.o_orderdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS ingested_at_utc
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

ZONES_SQL = """
SELECT CAST(n.n_nationkey + 1 AS INTEGER) AS locationid, n.n_name AS zone, r.r_name AS borough,
       CASE WHEN n.n_regionkey = 1 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


# ---------------------------------------------------------------- drifted files

def drifted_generations(spark: SparkSession, sf_dir: str, service: str = "yellow") -> list[DataFrame]:
    """Raw trips of a service split into three file generations with different layouts:
    up to 1997 without ``cbd_congestion_fee`` and ids stored as doubles (NaN for
    missing); 1998-1999 with upper-case column names and passenger counts as text ('n/a'
    for 0); 2000 on in the declared layout."""
    raw = raw_service(spark, sf_dir, service)
    a = (raw.where(F.col("source_year") <= 1997).drop("cbd_congestion_fee")
         .withColumn("PULocationID", F.coalesce(F.col("PULocationID").cast("double"), F.lit(float("nan"))))
         .withColumn("VendorID", F.col("VendorID").cast("double")))
    upper = {"airport_fee": "Airport_fee", "trip_type": "Trip_Type", "cbd_congestion_fee": "CBD_CONGESTION_FEE"}
    b = (raw.where(F.col("source_year").between(1998, 1999))
         .withColumnsRenamed({k: v for k, v in upper.items() if k in raw.columns})
         .withColumn("passenger_count", F.when(F.col("passenger_count") == 0, F.lit("n/a"))
                     .otherwise(F.col("passenger_count").cast("string"))))
    c = raw.where(F.col("source_year") >= 2000)
    return [a, b, c]


# ---------------------------------------------------------------- ledger fixture

# Fixed quality gate of the ledger fixture: a month whose share of trips without a
# total exceeds the first limit fails its first attempt; the retry uses the second.
FIRST_GATE, RETRY_GATE = 0.005, 0.01


def ledger_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of two ingest attempts derived from the trips: every month present is
    attempted once; months failing the gate are retried once."""
    months = (trips(spark, sf_dir)
              .groupBy(F.col("service_type").alias("service"), F.col("source_year").alias("year"),
                       F.col("source_month").alias("month"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.col("total_amount").isNull().cast("long")).alias("bad"),
                   F.max("ingested_at_utc").alias("ts")))
    share = F.col("bad") / F.col("n")

    def attempt(gate: float, tag: str) -> DataFrame:
        ok = share <= gate
        return months.select(
            "service", "year", "month",
            F.when(ok, F.col("n")).otherwise(F.lit(0)).cast("long").alias("rows"),
            F.when(ok, "OK").otherwise("ERROR").alias("status"),
            F.lit(tag).alias("run_tag"),
            F.col("ts").cast("timestamp").alias("ts_utc"),
            F.when(~ok, F.lit("share of trips without total above gate")).alias("error"))

    first = attempt(FIRST_GATE, "run1")
    retry = attempt(RETRY_GATE, "run2").join(first.where("status = 'ERROR'").select("service", "year", "month"),
                                             ["service", "year", "month"], "left_semi")
    return first.unionByName(retry)


LEDGER_SQL = f"""
months AS (
  SELECT service_type AS service, source_year AS year, source_month AS month, COUNT(*) AS n,
         SUM(CASE WHEN total_amount IS NULL THEN 1 ELSE 0 END) AS bad
  FROM trips GROUP BY 1, 2, 3),
ledger AS (
  SELECT service, year, month, CASE WHEN bad / n <= {FIRST_GATE} THEN n ELSE 0 END AS rows,
         CASE WHEN bad / n <= {FIRST_GATE} THEN 'OK' ELSE 'ERROR' END AS status
  FROM months
  UNION ALL
  SELECT service, year, month, CASE WHEN bad / n <= {RETRY_GATE} THEN n ELSE 0 END,
         CASE WHEN bad / n <= {RETRY_GATE} THEN 'OK' ELSE 'ERROR' END
  FROM months WHERE bad / n > {FIRST_GATE})"""
