"""Ingestion job: monthly trip files -> raw Parquet tables, with an audit ledger.

Work list = wanted (service, year, month) minus months with an OK ledger row. Each
month is conformed to the declared raw schema, stamped with lineage and written
with dynamic partition overwrite into ``source_year/source_month`` partitions, so a
rerun replaces the month instead of duplicating it. The row count is observed in the
write itself. The ledger row is appended only after the data commit; a failing month
is recorded as ERROR and the others go on.

Months are landed several at a time by a bounded pool of threads, each month as a job group
of its own in a FAIR scheduler pool (``spark.scheduler.mode=FAIR``), so that a large month
does not hold up small ones. Every month stages its files in its own folder until commit.
Ledger rows are appended by the calling thread alone, one commit for the months that have
ended meanwhile.

    spark-submit -m cabline.plans.ingest --base s3://.../trip-data --out s3://.../raw \
        --ledger s3://.../ledger --services yellow,green --year-start 2022 --year-end 2024
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target
from pyspark.sql import functions as F

from cabline import schemas
from cabline.sources import ledger as LG
from cabline.sources import sinks
from cabline.sources.conform import add_metadata, conform_schema, utc_now
from cabline.sources.files import read_month, read_zones_csv


# Fixed value: run tag format of the landed rows (prefix and UTC time stamp).
RUN_TAG_FORMAT = "ingesta_%Y%m%d_%H%M%S"


def default_run_tag() -> str:
    return datetime.now(timezone.utc).strftime(RUN_TAG_FORMAT)


def land_month(spark: SparkSession, base: str, out: str, service: str, year: int, month: int, run_tag: str, tolerant: bool) -> int:
    """Land one month; returns its rows."""
    df = conform_schema(read_month(spark, base, service, year, month), schemas.RAW_BY_SERVICE[service], tolerant=tolerant)
    df = add_metadata(df, year, month, run_tag, service=service)
    return sinks.write_table(df, f"{out.rstrip('/')}/{service}", "overwrite", ("source_year", "source_month"), dynamic=True)


def _landed(spark: SparkSession, todo: list, land, workers: int) -> Iterator[list[tuple]]:
    """(month, rows, error) of the months that have ended since the last look, until all
    have; ``workers`` months run at a time."""
    def task(r):
        sc = spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", "ingest")
        sc.setJobGroup(f"ingest-{r['service']}-{r['year']}-{r['month']:02d}", f"land {r['service']} {r['year']}-{r['month']:02d}")
        return land(r["service"], r["year"], r["month"])

    with ThreadPoolExecutor(max_workers=workers) as pool:
        running = {pool.submit(inheritable_thread_target(spark)(task), r): r for r in todo}
        left = set(running)
        while left:
            done, left = wait(left, return_when=FIRST_COMPLETED)
            yield [((running[f]["service"], running[f]["year"], running[f]["month"]), 0 if f.exception() else f.result(), f.exception()) for f in done]


def ingest(spark: SparkSession, base: str, out: str, ledger_path: str, services, years, months=range(1, 13),
           run_tag: str | None = None, tolerant: bool = False, workers: int = 4) -> dict:
    """Land every wanted month that has no OK attempt, ``workers`` months at a time."""
    run_tag = run_tag or default_run_tag()
    wanted = LG.month_grid(spark, services, years, months)
    todo = LG.pending_months(wanted, LG.read_ledger(spark, ledger_path)).orderBy(*LG.KEYS).collect()   # bounded by months
    totals = {"rows": 0, "errors": 0, "loaded": []}
    land = lambda s, y, m: land_month(spark, base, out, s, y, m, run_tag, tolerant)
    for ended in _landed(spark, todo, land, workers):
        LG.append_attempts(spark, ledger_path, [
            (s, y, m, LG.ERROR if failed else LG.OK, rows, run_tag, str(failed) if failed else None) for (s, y, m), rows, failed in ended])
        totals["rows"] += sum(rows for _, rows, _ in ended)
        totals["errors"] += sum(failed is not None for _, _, failed in ended)
        totals["loaded"] += [key for key, _, failed in ended if failed is None]
    totals["loaded"].sort()
    if LG.ledger_files(spark, ledger_path) > LG.MANY_FILES:
        LG.compact_ledger(spark, ledger_path)
    return totals


def load_dimension(spark: SparkSession, csv_path: str, out: str, run_tag: str) -> int:
    """Zone CSV -> normalised headers -> lineage -> unique-key check -> full refresh."""
    z = read_zones_csv(spark, csv_path)
    dup = z.groupBy("locationid").count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError("zone ids are not unique")
    z = z.withColumns({"run_tag": F.lit(run_tag), "ingested_at_utc": utc_now()})
    return sinks.write_table(z, out, "overwrite", ())


def table_counts(spark: SparkSession, paths: dict[str, str]):
    """Row count per landed table plus a combined total, from the files' footers."""
    rows = [(name, int(sinks.footer_counts(spark, p).first()["rows"])) for name, p in paths.items()]
    rows.append(("TOTAL", sum(n for _, n in rows)))
    return spark.createDataFrame(rows, "table string, rows long")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Land monthly trip files into raw tables")
    ap.add_argument("--base", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--ledger", required=True)
    ap.add_argument("--services", default="yellow,green")
    ap.add_argument("--year-start", type=int, default=2015)
    ap.add_argument("--year-end", type=int, default=2025)
    ap.add_argument("--run-tag", default=None)
    ap.add_argument("--tolerant", action="store_true")
    ap.add_argument("--workers", type=int, default=4, help="months landed at a time")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    res = ingest(spark, a.base, a.out, a.ledger, [s.strip() for s in a.services.split(",")],
                 range(a.year_start, a.year_end + 1), run_tag=a.run_tag, tolerant=a.tolerant, workers=a.workers)
    print({k: v for k, v in res.items() if k != "loaded"})


if __name__ == "__main__":
    main()
