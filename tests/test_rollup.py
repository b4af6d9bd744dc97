"""Incremental summaries against the full ones, before and after partitions change."""

from pyspark.sql import functions as F

from cabline.operators import profile, rollup
from cabline.sources import sinks


def _wide(spark, rows):
    df = spark.createDataFrame(rows, "source_year int, service_type string, year int, month int, minute int, vendor_id int, pu_location_id int")
    return df.select("*", F.timestamp_seconds(F.col("minute") * 60).alias("pickup_datetime"), F.col("vendor_id").alias("rate_code_id"),
                     F.lit(1).alias("payment_type"), F.lit(None).cast("int").alias("do_location_id")).drop("minute")


def _same(spark, wide_path, summary_path):
    wide, cells = spark.read.parquet(wide_path), spark.read.parquet(summary_path)
    for full, part in ((profile.service_summary(wide), rollup.service_summary(cells)), (profile.year_service_counts(wide), rollup.year_service_counts(cells)),
                       (profile.service_year_ranges(wide), rollup.service_year_ranges(cells)),
                       (profile.rows_per(wide, ["year", "month"]), rollup.rows_per_month(cells)),
                       (profile.cardinality(wide, list(rollup.SKETCHED)), rollup.cardinality(cells))):
        assert [tuple(r) for r in full.collect()] == [tuple(r) for r in part.collect()]


def test_refresh_follows_replaced_new_and_emptied_partitions(spark, tmp_path):
    wide_path, summary_path = str(tmp_path / "w"), str(tmp_path / "s")
    rows = [(2020 + i % 2, ["yellow", "green"][i % 3 % 2], 2020 + i % 2 - (i % 50 == 0), i % 12 + 1, i * 37, i % 3, i % 20) for i in range(900)]
    parts = [(y, s) for y in (2020, 2021) for s in ("yellow", "green")]
    sinks.full_rebuild(_wide(spark, rows), wide_path, overwrite=True)
    rollup.refresh(spark, wide_path, summary_path, parts)
    _same(spark, wide_path, summary_path)
    changed = [(2021, "yellow", 2021, 5, 10, 7, 3), (2022, "green", 2022, 1, 99, None, None)]
    sinks.partition_replace(spark, _wide(spark, changed), wide_path, [(2021, "yellow"), (2022, "green"), (2020, "green")], overwrite=True)
    res = rollup.refresh(spark, wide_path, summary_path, [(2021, "yellow"), (2022, "green"), (2020, "green")])
    assert res["emptied"] == [(2020, "green")] and res["new"] == [(2022, "green")] and res["replaced"] == [(2021, "yellow")]
    _same(spark, wide_path, summary_path)
    assert rollup.refresh(spark, wide_path, summary_path, [])["written"] == 0
