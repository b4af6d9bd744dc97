"""Sinks: emptied partitions, full rebuild under a dynamic setting, damaged tables."""

import pytest
from pyspark.sql import functions as F

from cabline.sources import ledger as LG
from cabline.sources import sinks


def _rows(spark, years):
    return spark.createDataFrame([(i, y, "yellow") for i, y in enumerate(years)], "v int, source_year int, service_type string")


def _years(spark, path):
    return sorted({r.source_year for r in spark.read.parquet(path).collect()})


def test_requested_partition_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_rebuild(_rows(spark, [2020, 2021, 2021]), path, overwrite=True)
    res = sinks.partition_replace(spark, _rows(spark, [2020]), path, [(2021, "yellow"), (2022, "yellow")], overwrite=True)
    assert res == {"written": 0, "skipped": [], "replaced": [], "new": [], "emptied": [(2021, "yellow")]}
    assert _years(spark, path) == [2020]


def test_full_rebuild_replaces_all_under_a_dynamic_setting(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.full_rebuild(_rows(spark, [2020, 2021]), path, overwrite=True)
        sinks.full_rebuild(_rows(spark, [2022]), path, overwrite=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert _years(spark, path) == [2022]


def test_damaged_table_is_an_error_and_not_an_absent_one(spark, tmp_path):
    assert not sinks.table_exists(spark, str(tmp_path / "none"))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    assert sinks.table_exists(spark, str(bad))
    with pytest.raises(Exception):
        sinks.partition_replace(spark, _rows(spark, [2020]), str(bad), [(2020, "yellow")], overwrite=False)
    with pytest.raises(Exception):
        LG.read_ledger(spark, str(bad)).collect()
    assert LG.read_ledger(spark, str(tmp_path / "none")).count() == 0


def test_counts_come_from_the_write(spark, tmp_path):
    assert sinks.write_table(_rows(spark, [2020, 2021]).where(F.lit(True)), str(tmp_path / "c"), "overwrite") == 2


def _files(path):
    return [p for p in path.rglob("*.parquet") if "_temporary" not in str(p)]


def test_partitioned_writes_make_few_sorted_files(spark, tmp_path):
    """From 40 tasks that all hold rows of all partitions: a file or two a partition, ordered
    by time inside, so that a range filter meets few row groups."""
    df = spark.range(0, 20_000, 1, 40).select(
        (F.col("id") % 3 + 2020).cast("int").alias("source_year"), F.when(F.col("id") % 2 == 0, "yellow").otherwise("green").alias("service_type"),
        F.timestamp_seconds(F.hash("id") % 100_000).alias("pickup_datetime"), "id")
    out = tmp_path / "t"
    assert sinks.full_rebuild(df, str(out), overwrite=True) == 20_000
    assert len(_files(out)) <= 12
    import pyarrow.parquet as pq
    for f in _files(out):
        t = pq.read_table(f, columns=["pickup_datetime"])["pickup_datetime"].to_pylist()
        assert t == sorted(t)
    assert spark.read.parquet(str(out)).agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_rebuild(_rows(spark, [2020, 2021, 2021]), path, overwrite=True)
    for keys in ((), ("source_year", "service_type")):
        counts = sinks.footer_counts(spark, path, keys)
        assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    got = {(r["source_year"], r["service_type"]): r["rows"] for r in counts.collect()}
    assert got == {(2020, "yellow"): 1, (2021, "yellow"): 2}
    some = sinks.existing_partitions(spark, path, only=[(2021, "yellow"), (2030, "green")]).collect()
    assert [tuple(r) for r in some] == [(2021, "yellow", 2)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_catalog_follows_the_table(spark, tmp_path):
    path, name = str(tmp_path / "t"), "cabline_test.wide"
    schema = _rows(spark, [2020]).schema
    spark.sql("DROP TABLE IF EXISTS cabline_test.wide")
    try:
        sinks.ensure_table(spark, name, schema, path)
        sinks.ensure_table(spark, name, schema, path)
        assert spark.table(name).count() == 0
        sinks.partition_replace(spark, _rows(spark, [2020, 2021]), path, [(2020, "yellow"), (2021, "yellow")], overwrite=True)
        assert sinks.register_partitions(spark, name, path)["added"] == [("2020", "yellow"), ("2021", "yellow")]
        assert sorted(r["source_year"] for r in spark.table(name).collect()) == [2020, 2021]
        assert sinks.register_partitions(spark, name, path) == {"added": [], "dropped": []}
        sinks.partition_replace(spark, _rows(spark, [2020]), path, [(2021, "yellow")], overwrite=True)
        assert sinks.register_partitions(spark, name, path)["dropped"] == [("2021", "yellow")]
        assert [r["source_year"] for r in spark.table(name).collect()] == [2020]
    finally:
        spark.sql("DROP DATABASE IF EXISTS cabline_test CASCADE")


def test_ledger_of_a_thousand_attempts_is_compacted_under_a_reader(spark, tmp_path):
    path = str(tmp_path / "l")
    for k in range(8):
        LG.append_attempts(spark, path, [("yellow", 2000 + i // 12, i % 12 + 1, LG.OK if (i + k) % 3 else LG.ERROR, i, f"r{k}", None if (i + k) % 3 else "x" * 900)
                                         for i in range(k * 40, k * 40 + 125)])
    grid = LG.month_grid(spark, ["yellow"], range(2000, 2040))
    pending = lambda: {tuple(r) for r in LG.pending_months(grid, LG.read_ledger(spark, path)).collect()}
    before, reader = pending(), LG.read_ledger(spark, path)
    assert reader.count() == 1_000 and LG.ledger_files(spark, path) == 8
    assert LG.compact_ledger(spark, path) == 1 and pending() == before
    assert reader.count() == 1_000                       # listed before, read after
    LG.append_ledger(spark, path, "yellow", 2039, 12, LG.OK, 5, "later")
    assert LG.ledger_files(spark, path) == 2 and LG.read_ledger(spark, path).count() == 1_001
    LG.compact_ledger(spark, path)
    assert len(LG._generations(spark, path)) == 2 and LG.read_ledger(spark, path).count() == 1_001
    (tmp_path / "l" / "gen-000009").mkdir()              # a compaction that did not commit does not count
    assert LG.read_ledger(spark, path).count() == 1_001
    assert LG.read_ledger(spark, path).agg(F.max(F.length("error"))).first()[0] == 500


def test_flat_ledger_is_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "l")
    LG.append_ledger(spark, str(tmp_path / "other"), "green", 2020, 1, LG.OK, 1, "r")
    LG.read_ledger(spark, str(tmp_path / "other")).write.parquet(path)
    LG.append_ledger(spark, path, "green", 2020, 2, LG.OK, 1, "r")
    assert LG.read_ledger(spark, path).count() == 2 and LG.compact_ledger(spark, path) == 1 and LG.read_ledger(spark, path).count() == 2
