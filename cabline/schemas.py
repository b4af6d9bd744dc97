"""Declared table schemas (raw trips per service, zone dimension, wide table, ledger)."""

from __future__ import annotations

from pyspark.sql import types as T

I, D, S, TS = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LINEAGE = [("run_tag", S), ("source_year", I), ("source_month", I), ("ingested_at_utc", TS)]

_RAW_COMMON_HEAD = [("VendorID", I)]
_RAW_COMMON_TAIL = [
    ("passenger_count", I), ("trip_distance", D), ("RatecodeID", I), ("store_and_fwd_flag", S),
    ("PULocationID", I), ("DOLocationID", I), ("payment_type", I), ("fare_amount", D),
    ("extra", D), ("mta_tax", D), ("tip_amount", D), ("tolls_amount", D),
    ("improvement_surcharge", D), ("total_amount", D), ("congestion_surcharge", D),
]

RAW_YELLOW = _struct(
    _RAW_COMMON_HEAD
    + [("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS)]
    + _RAW_COMMON_TAIL
    + [("airport_fee", D), ("cbd_congestion_fee", D)]
)

RAW_GREEN = _struct(
    _RAW_COMMON_HEAD
    + [("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS)]
    + _RAW_COMMON_TAIL
    + [("trip_type", I), ("cbd_congestion_fee", D)]
)

RAW_BY_SERVICE = {"yellow": RAW_YELLOW, "green": RAW_GREEN}

ZONES = _struct([("locationid", I), ("zone", S), ("borough", S), ("service_zone", S)])

WIDE = _struct([
    ("pickup_datetime", TS), ("dropoff_datetime", TS), ("pickup_hour", I), ("pickup_dow", I),
    ("month", I), ("year", I), ("pu_location_id", I), ("pu_zone", S), ("pu_borough", S),
    ("do_location_id", I), ("do_zone", S), ("do_borough", S), ("service_type", S),
    ("vendor_id", I), ("vendor_name", S), ("rate_code_id", I), ("rate_code_desc", S),
    ("payment_type", I), ("payment_type_desc", S), ("trip_type", I), ("passenger_count", I),
    ("trip_distance", D), ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D),
    ("tolls_amount", D), ("improvement_surcharge", D), ("congestion_surcharge", D),
    ("cbd_congestion_fee", D), ("airport_fee", D), ("total_amount", D), ("store_and_fwd_flag", S),
    ("trip_duration_min", D), ("avg_speed_mph", D), ("tip_pct", D), ("run_id", S),
    ("source_year", I), ("source_month", I), ("ingested_at_utc", TS),
])

WIDE_COLUMNS = [f.name for f in WIDE.fields]

# One fixed column order for the ledger (status before rows is not kept).
LEDGER = T.StructType([
    T.StructField("service", S, False), T.StructField("year", I, False),
    T.StructField("month", I, False), T.StructField("rows", T.LongType(), False),
    T.StructField("status", S, False), T.StructField("run_tag", S, True),
    T.StructField("ts_utc", T.TimestampType(), True), T.StructField("error", S, True),
])

LEADERBOARD = T.StructType([
    T.StructField("model", S), T.StructField("type", S), T.StructField("val_rmse", D),
    T.StructField("val_mae", D), T.StructField("val_r2", D), T.StructField("train_time", D),
    T.StructField("n_features", I),
])

# The sampled projection the modelling stage reads (22 of the 40 wide columns).
SAMPLE_COLUMNS = [
    "pickup_datetime", "pickup_hour", "pickup_dow", "month", "year", "pu_location_id",
    "pu_zone", "pu_borough", "service_type", "vendor_id", "rate_code_id", "payment_type",
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
    "store_and_fwd_flag",
]


def raw_with_lineage(service: str) -> T.StructType:
    """Raw table of a service plus lineage and service columns, as landed."""
    fields = list(RAW_BY_SERVICE[service].fields) + [T.StructField(n, t, True) for n, t in LINEAGE]
    return T.StructType(fields + [T.StructField("service_type", S, True)])
