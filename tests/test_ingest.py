"""Ingest job: idempotent monthly landing, ledger states, streaming variant, drift."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabline import schemas
from cabline.plans import bindings as B
from cabline.plans.ingest import ingest
from cabline.sources import ledger as LG
from cabline.sources.conform import conform_schema
from cabline.sources.files import source_path
from conftest import SF_SMALL

MONTHS = [(1996, 1), (1996, 2), (1996, 3)]


@pytest.fixture(scope="module")
def landing(spark):
    base = tempfile.mkdtemp(prefix="cabline-land-")
    raw = B.raw_service(spark, SF_SMALL, "yellow")
    cols = [f.name for f in schemas.RAW_YELLOW.fields]
    for y, m in MONTHS:
        part = raw.where((F.col("source_year") == y) & (F.col("source_month") == m)).select(*cols)
        if (y, m) == (1996, 3):      # a broken month: ids as unparsable text
            part = part.withColumn("VendorID", F.lit("x"))
        part.coalesce(1).write.parquet(source_path(base, "yellow", y, m))
    expected = {(y, m): raw.where((F.col("source_year") == y) & (F.col("source_month") == m)).count()
                for y, m in MONTHS}
    return base, expected


def test_ingest_twice_and_retry(spark, landing):
    base, expected = landing
    out, led = tempfile.mkdtemp(prefix="cabline-raw-"), tempfile.mkdtemp(prefix="cabline-led-") + "/l"
    r1 = ingest(spark, base, out, led, ["yellow"], [1996], [1, 2, 3, 4], run_tag="r1")
    assert r1["errors"] == 2                       # broken month + absent month
    assert r1["rows"] == expected[(1996, 1)] + expected[(1996, 2)]
    r2 = ingest(spark, base, out, led, ["yellow"], [1996], [1, 2, 3, 4], run_tag="r2")
    assert r2["rows"] == 0 and r2["errors"] == 2   # OK months are skipped
    landed = spark.read.parquet(f"{out}/yellow")
    assert landed.count() == expected[(1996, 1)] + expected[(1996, 2)]   # no duplicates
    # tolerant mode loads the broken month (bad ids become NULL); the ledger shows ERROR then OK
    r3 = ingest(spark, base, out, led, ["yellow"], [1996], [3], run_tag="r3", tolerant=True)
    assert r3["rows"] == expected[(1996, 3)]
    states = {(r["month"], tuple(r["s"])) for r in LG.read_ledger(spark, led).groupBy("month")
              .agg(F.sort_array(F.collect_list("status")).alias("s")).collect()}
    assert (3, ("ERROR", "ERROR", "OK")) in states and (4, ("ERROR", "ERROR")) in states and (1, ("OK",)) in states
    assert spark.read.parquet(f"{out}/yellow").where("source_month = 3").where("VendorID IS NOT NULL").count() == 0
    pend = LG.pending_months(LG.month_grid(spark, ["yellow"], [1996], [1, 2, 3, 4]), LG.read_ledger(spark, led))
    assert [tuple(r) for r in pend.collect()] == [("yellow", 1996, 4)]


def test_streaming_ingest(spark, landing):
    from cabline.streaming.ingest_stream import start
    _, expected = landing
    base = tempfile.mkdtemp(prefix="cabline-land2-")
    raw = B.raw_service(spark, SF_SMALL, "yellow")
    cols = [f.name for f in schemas.RAW_YELLOW.fields]
    for y, m in MONTHS:
        raw.where((F.col("source_year") == y) & (F.col("source_month") == m)).select(*cols) \
           .coalesce(1).write.parquet(source_path(base, "yellow", y, m))
    d = tempfile.mkdtemp(prefix="cabline-stream-")
    q = start(spark, base, "yellow", f"{d}/raw", f"{d}/ledger", f"{d}/ckpt", "s1")
    q.awaitTermination(300)
    got = {(r["source_year"], r["source_month"]): r["count"]
           for r in spark.read.parquet(f"{d}/raw/yellow").groupBy("source_year", "source_month").count().collect()}
    assert got[(1996, 1)] == expected[(1996, 1)] and got[(1996, 2)] == expected[(1996, 2)]
    assert got[(1996, 3)] == expected[(1996, 3)]
    q2 = start(spark, base, "yellow", f"{d}/raw", f"{d}/ledger", f"{d}/ckpt", "s2")
    q2.awaitTermination(300)
    assert LG.read_ledger(spark, f"{d}/ledger").count() == 3     # nothing new on the rerun


def test_conform_case_alias_and_backfill(spark):
    df = spark.createDataFrame([("1", 2.0, "7")], "vendorid string, Airport_fee double, passenger_count string")
    target = schemas.RAW_YELLOW
    out = conform_schema(df, target, tolerant=True).first()
    assert out["VendorID"] == 1 and out["airport_fee"] == 2.0 and out["passenger_count"] == 7
    assert out["cbd_congestion_fee"] is None and [f.name for f in conform_schema(df, target).schema] == target.fieldNames()
    bad = spark.createDataFrame([("x",)], "VendorID string")
    assert conform_schema(bad, target, tolerant=True).first()["VendorID"] is None
    with pytest.raises(Exception):
        conform_schema(bad, target).collect()


def test_read_months_one_scan(spark, landing):
    from cabline.sources.files import read_months
    base, expected = landing
    paths = [source_path(base, "yellow", y, m) for y, m in MONTHS[:2]]
    df = read_months(spark, paths)
    got = {(r["_file_year"], r["_file_month"]): r["count"]
           for r in df.groupBy("_file_year", "_file_month").count().collect()}
    assert got == {(1996, 1): expected[(1996, 1)], (1996, 2): expected[(1996, 2)]}


def test_zone_csv_dimension(spark):
    from cabline.plans.ingest import load_dimension
    d = tempfile.mkdtemp(prefix="cabline-zones-")
    with open(os.path.join(d, "zones.csv"), "w") as f:
        f.write("LocationID,Borough,Zone,Service Zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n")
    n = load_dimension(spark, os.path.join(d, "zones.csv"), os.path.join(d, "out"), "z1")
    z = spark.read.parquet(os.path.join(d, "out"))
    assert n == 2 and set(z.columns) >= {"locationid", "zone", "borough", "service_zone", "run_tag"}
    assert {r["locationid"]: r["service_zone"] for r in z.collect()} == {1: "EWR", 2: "Boro Zone"}
    with open(os.path.join(d, "dup.csv"), "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,A,B,C\n1,A,B,C\n")
    with pytest.raises(ValueError):
        load_dimension(spark, os.path.join(d, "dup.csv"), os.path.join(d, "out2"), "z1")


def _put(spark, base, name, y, m, part, rows):
    """One more file of a month, with ``rows`` rows."""
    cols = [f.name for f in schemas.RAW_YELLOW.fields]
    raw = B.raw_service(spark, SF_SMALL, "yellow").select(*cols).limit(rows)
    raw.withColumn("trip_distance", F.lit(float(part))).coalesce(1).write.mode("append").parquet(source_path(base, name, y, m))


def _landed_rows(spark, d):
    table = {(r["source_year"], r["source_month"]): r["count"]
             for r in spark.read.parquet(f"{d}/raw/yellow").groupBy("source_year", "source_month").count().collect()}
    ledger = {(r["year"], r["month"]): r["s"] for r in LG.read_ledger(spark, f"{d}/ledger").groupBy("year", "month").agg(F.sum("rows").alias("s")).collect()}
    assert table == ledger
    return table


def test_stream_keeps_every_row_of_a_month(spark):
    """A month in several files over several triggers, a late file, and a batch run again."""
    from cabline.streaming import ingest_stream as S
    base, d = tempfile.mkdtemp(prefix="cabline-land3-"), tempfile.mkdtemp(prefix="cabline-stream3-")
    for part, rows in ((1, 10), (2, 20), (3, 5)):
        _put(spark, base, "yellow", 1996, 1, part, rows)
    _put(spark, base, "yellow", 1996, 2, 1, 7)
    S.start(spark, base, "yellow", f"{d}/raw", f"{d}/ledger", f"{d}/ckpt", "s1", max_files_per_trigger=1).awaitTermination(300)
    assert _landed_rows(spark, d) == {(1996, 1): 35, (1996, 2): 7}
    assert LG.read_ledger(spark, f"{d}/ledger").count() == 4
    _put(spark, base, "yellow", 1996, 1, 4, 3)                   # a late file adds to the month
    S.start(spark, base, "yellow", f"{d}/raw", f"{d}/ledger", f"{d}/ckpt", "s2").awaitTermination(300)
    assert _landed_rows(spark, d) == {(1996, 1): 38, (1996, 2): 7}
    # a batch that landed, but whose commit was lost, is run again under another run tag
    last = max(r["ingest_batch"] for r in spark.read.parquet(f"{d}/raw/yellow").select("ingest_batch").distinct().collect())
    rows = spark.read.parquet(f"{d}/raw/yellow").where(F.col("ingest_batch") == last)
    stored = rows.drop("ingest_batch").collect()
    S.land_batch(spark.createDataFrame(stored, rows.drop("ingest_batch").schema), f"{d}/raw/yellow", f"{d}/ledger", "yellow", "s3", last)
    assert _landed_rows(spark, d) == {(1996, 1): 38, (1996, 2): 7}
    # one that wrote its rows and died before its ledger rows gets them now
    S.land_batch(spark.createDataFrame(stored, rows.drop("ingest_batch").schema), f"{d}/raw/yellow", f"{d}/ledger2", "yellow", "s3", last)
    assert LG.read_ledger(spark, f"{d}/ledger2").agg(F.sum("rows")).first()[0] == 3


def test_months_land_together_and_fail_alone(spark, monkeypatch):
    import time

    from cabline.plans import ingest as I
    base, out = tempfile.mkdtemp(prefix="cabline-land4-"), tempfile.mkdtemp(prefix="cabline-raw4-")
    months = range(1, 11)
    for m in months:
        _put(spark, base, "yellow", 1997, m, m, m)
    (bad,) = [m for m in months if m == 6]
    import pathlib
    for f in pathlib.Path(source_path(base, "yellow", 1997, bad)).glob("*.parquet"):
        f.write_bytes(b"not parquet")
    groups, took, real = set(), [], I.land_month

    def timed(*a):
        groups.add(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "ingest"
        t = time.time()
        try:
            time.sleep(0.5)
            return real(*a)
        finally:
            took.append(time.time() - t)

    monkeypatch.setattr(I, "land_month", timed)
    t = time.time()
    totals = I.ingest(spark, base, out, f"{out}/ledger", ["yellow"], [1997], months, run_tag="r", workers=5)
    assert time.time() - t < sum(took) and len(groups) == 10
    assert totals["errors"] == 1 and totals["loaded"] == [("yellow", 1997, m) for m in months if m != bad]
    got = {r["source_month"]: r["count"] for r in spark.read.parquet(f"{out}/yellow").groupBy("source_month").count().collect()}
    assert got == {m: m for m in months if m != bad} and totals["rows"] == sum(got.values())
    ledger = {r["month"]: (r["status"], r["rows"]) for r in LG.read_ledger(spark, f"{out}/ledger").collect()}
    assert ledger == {m: (LG.OK, m) if m != bad else (LG.ERROR, 0) for m in months}
    again = I.ingest(spark, base, out, f"{out}/ledger", ["yellow"], [1997], months, run_tag="r2", workers=5)
    assert again["loaded"] == [] and again["errors"] == 1
