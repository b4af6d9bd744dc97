"""Wide projection edges on an inline fixture (NULL/zero/negative/unknown cases)."""

import datetime as dt

from pyspark.sql import functions as F

from cabline import schemas
from cabline.operators.wide import SERVICES, build_wide, wide_projection
from cabline.sources.conform import add_metadata, conform_schema

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)


def _raw(spark, rows, service="yellow"):
    target = schemas.raw_with_lineage(service)
    prefix = "tpep" if service == "yellow" else "lpep"
    df = spark.createDataFrame(rows, "VendorID int, pu timestamp_ntz, do timestamp_ntz, dist double, "
                                     "total double, tip double, PULocationID int, RatecodeID int, payment_type int")
    df = df.withColumnsRenamed({"pu": f"{prefix}_pickup_datetime", "do": f"{prefix}_dropoff_datetime",
                                "dist": "trip_distance", "total": "total_amount", "tip": "tip_amount"})
    df = add_metadata(df, 2024, 3, "t", F.lit(T0).cast("timestamp_ntz"), service)
    return conform_schema(df, target)


def _zones(spark):
    return spark.createDataFrame([(1, "Z1", "B1", "S"), (2, "Z2", "B2", "S")], schemas.ZONES)


def test_edges(spark):
    rows = [
        (1, T0, None, 1.0, 10.0, 1.0, 1, 1, 1),                       # null dropoff
        (2, T0, T0, 0.0, 0.0, 1.0, 2, 2, 0),                          # zero duration, total 0
        (6, T0, T0 - dt.timedelta(minutes=5), 2.0, -5.0, 1.0, 3, 9, 7),  # negative duration, unknown codes
        (None, T0, T0 + dt.timedelta(minutes=30), 0.0, None, 1.0, None, None, None),  # nulls, zero distance
        (7, T0, T0 + dt.timedelta(minutes=90), 30.0, 20.0, 2.0, 1, 6, 6),
    ]
    out = wide_projection(_raw(spark, rows), SERVICES["yellow"], _zones(spark)).collect()
    assert len(out) == 5
    by_vendor = {row["vendor_id"]: row for row in out}
    assert by_vendor[1]["trip_duration_min"] == 0.0 and by_vendor[1]["avg_speed_mph"] is None
    assert by_vendor[2]["trip_duration_min"] == 0.0 and by_vendor[2]["tip_pct"] is None
    assert by_vendor[6]["trip_duration_min"] == 0.0 and by_vendor[6]["avg_speed_mph"] is None
    assert by_vendor[6]["rate_code_desc"] == "Other" and by_vendor[6]["payment_type_desc"] == "Other"
    assert by_vendor[6]["pu_zone"] is None
    assert by_vendor[None]["vendor_name"] == "Other" and by_vendor[None]["avg_speed_mph"] == 0.0
    assert by_vendor[None]["tip_pct"] is None and by_vendor[None]["pu_zone"] is None
    assert by_vendor[7]["avg_speed_mph"] == 20.0 and by_vendor[7]["tip_pct"] == 0.1
    assert by_vendor[7]["vendor_name"] == "Helix" and by_vendor[7]["rate_code_desc"] == "Group ride"
    assert by_vendor[1]["pickup_dow"] == 5 and by_vendor[1]["pickup_hour"] == 8   # 2024-03-01 is a Friday
    assert by_vendor[1]["trip_type"] is None and by_vendor[1]["service_type"] == "yellow"
    assert [f.name for f in wide_projection(_raw(spark, rows), SERVICES["yellow"], _zones(spark)).schema] \
        == schemas.WIDE_COLUMNS


def test_union_and_unknown_service(spark):
    y = _raw(spark, [(1, T0, T0, 1.0, 10.0, 1.0, 1, 1, 1)], "yellow")
    g = _raw(spark, [(2, T0, T0, 1.0, 10.0, 1.0, 2, 1, 1)], "green")
    out = build_wide({"yellow": y, "green": g}, _zones(spark))
    got = {r["service_type"]: r for r in out.collect()}
    assert got["green"]["airport_fee"] is None and set(got) == {"yellow", "green"}
    try:
        build_wide({"yellow": y}, _zones(spark), services=["blue"])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
