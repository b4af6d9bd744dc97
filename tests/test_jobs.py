"""Job entry points end to end on raw tables landed from the bindings."""

import tempfile

import pytest
from pyspark.sql import functions as F

from cabline.operators import diagnose as DG
from cabline.operators.selection import exact_median
from cabline.operators.sample import basic_quality_filter
from cabline.plans import bindings as B
from cabline.plans.build import build
from cabline.plans.ingest import table_counts
from cabline.sources import ledger as LG
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark):
    d = tempfile.mkdtemp(prefix="cabline-job-")
    for s in ("yellow", "green"):
        B.raw_service(spark, SF_SMALL, s).write.partitionBy("source_year", "source_month").parquet(f"{d}/raw/{s}")
    B.zones(spark, SF_SMALL).write.parquet(f"{d}/zones")
    return d


def _counts(spark, path):
    return {(r["source_year"], r["service_type"]): (r["count"], r["run_id"])
            for r in spark.read.parquet(path).groupBy("source_year", "service_type", "run_id").count().collect()}


def test_build_full_and_by_partition(spark, landed):
    out = f"{landed}/wide"
    years = range(1995, 2002)
    first = build(spark, f"{landed}/raw", f"{landed}/zones", out, "full", years, ["yellow", "green"], True)
    total = sum(B.raw_service(spark, SF_SMALL, s).count() for s in ("yellow", "green"))
    assert first["written"] == total
    # full mode without overwrite appends: a rerun duplicates, as documented
    build(spark, f"{landed}/raw", f"{landed}/zones", out, "full", [1995], ["yellow"], False)
    assert spark.read.parquet(out).count() == total + spark.read.parquet(out).where(
        "source_year = 1995 AND service_type = 'yellow'").count() // 2
    # by-partition without overwrite skips every existing partition
    skip = build(spark, f"{landed}/raw", f"{landed}/zones", out, "by-partition", [1996], ["yellow", "green"], False)
    assert skip["written"] == 0 and len(skip["skipped"]) == 2
    # with overwrite it replaces only the requested partition (duplicates of 1995 go away)
    rep = build(spark, f"{landed}/raw", f"{landed}/zones", out, "by-partition", [1995], ["yellow"], True)
    assert rep["replaced"] == [(1995, "yellow")]
    assert spark.read.parquet(out).count() == total
    with pytest.raises(ValueError):
        build(spark, f"{landed}/raw", f"{landed}/zones", out, "full", [1995], ["blue"], True)


def test_table_counts_and_formatting(spark, landed):
    c = {r["table"]: r["rows"] for r in table_counts(spark, {
        "yellow": f"{landed}/raw/yellow", "green": f"{landed}/raw/green", "zones": f"{landed}/zones"}).collect()}
    assert c["TOTAL"] == c["yellow"] + c["green"] + c["zones"] and c["zones"] == 25
    led = spark.createDataFrame([("yellow", 1234567)], "service string, total_rows long")
    assert LG.format_rows(led).first()["total_rows"] == "1,234,567"


def test_small_helpers(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 2.0), (5.0, 0.0), (-3.0, 4.0), (7.0, 9.0)],
                               "total_amount double, trip_distance double")
    assert basic_quality_filter(df).count() == 2
    assert exact_median(df, "total_amount").first()["median"] == 1.0
    pts = spark.createDataFrame([(float(i), 2.0 * i + 1.0) for i in range(20)], "theoretical double, ordered double")
    line = DG.qq_line(pts).first()
    assert abs(line["slope"] - 2.0) < 1e-12 and abs(line["intercept"] - 1.0) < 1e-12 and abs(line["r"] - 1) < 1e-12


def test_model_job(spark, landed):
    from cabline.plans.model import run_job
    out = f"{landed}/wide_for_model"
    build(spark, f"{landed}/raw", f"{landed}/zones", out, "full", range(1995, 2002), ["yellow", "green"], True)
    res = run_job(spark, out, f"{landed}/model", list(range(1995, 2002)), 600)
    rep = spark.read.parquet(res["report"]).first()
    board = spark.read.parquet(res["leaderboard"]).collect()
    assert len(board) == 10 and rep["winner"] and rep["improvement_pct"] > 0


def test_build_keeps_catalog_and_summary_in_step(spark, landed):
    from cabline.operators import profile, rollup
    from cabline.plans.build import preview
    out, summary, table = f"{landed}/wide_listed", f"{landed}/wide_summary", "cabline_jobs.wide"
    spark.sql("DROP DATABASE IF EXISTS cabline_jobs CASCADE")
    try:
        build(spark, f"{landed}/raw", f"{landed}/zones", out, "full", [1996, 1997], ["yellow", "green"], True, table=table, summary=summary)
        build(spark, f"{landed}/raw", f"{landed}/zones", out, "by-partition", [1997, 1998], ["yellow"], True, "again", table, summary)
        wide = spark.read.parquet(out)
        assert spark.table(table).count() == wide.count() > 0
        assert [tuple(r) for r in rollup.service_year_ranges(spark.read.parquet(summary)).collect()] == [tuple(r) for r in profile.service_year_ranges(wide).collect()]
        assert {r["run_id"] for r in wide.where("source_year = 1998").collect()} == {"again"}
    finally:
        spark.sql("DROP DATABASE IF EXISTS cabline_jobs CASCADE")
    ids = [r["locationid"] for r in preview(spark, f"{landed}/zones", 5).collect()]
    assert ids == sorted(ids) and len(ids) == 5
