"""Audit ledger of ingested months: append, read, pending work, summaries.

The ledger is an append-only Parquet table (schema ``schemas.LEDGER``). A month
counts as loaded when it has at least one ``OK`` row.

Attempts are small files, so they are compacted: rows live in a folder per generation, and
a compaction writes all rows as the next generation, which counts from the moment its
write has committed (its ``_SUCCESS`` file exists). The generation before stays until the
next compaction, so a reader that listed it earlier can finish. One job writes a ledger at
a time; any number may read it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline import schemas
from cabline.sources.sinks import table_exists

OK, ERROR = "OK", "ERROR"
ERROR_TEXT_MAX = 500
KEYS = ["service", "year", "month"]


#: Files of the newest generation above which a job compacts its ledger.
MANY_FILES = 64


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _generations(spark: SparkSession, path: str) -> list[str]:
    """Committed generations, oldest first."""
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return []
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = sorted(f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory() and f.getPath().getName().startswith("gen-"))
    return [f"{path.rstrip('/')}/{n}" for n in names if fs.exists(jpath(f"{path.rstrip('/')}/{n}/_SUCCESS"))]


def _newest(spark: SparkSession, path: str) -> str | None:
    """Folder of the rows: the newest generation, or a flat table of files; None if absent."""
    found = _generations(spark, path)
    return found[-1] if found else path if table_exists(spark, path) else None


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty only when its folder is absent; access errors are raised."""
    now = _newest(spark, path)
    if now is None:
        return spark.createDataFrame([], schemas.LEDGER)
    return spark.read.schema(schemas.LEDGER).parquet(now)


def append_attempts(spark: SparkSession, path: str, attempts: Iterable[tuple]) -> None:
    """Append attempts (service, year, month, status, rows, run_tag, error) in one commit;
    error texts are cut to 500 characters."""
    rows = [(s, int(y), int(m), int(n or 0), status, tag, None, error or None) for s, y, m, status, n, tag, error in attempts]
    if not rows:
        return
    df = (spark.createDataFrame(rows, schemas.LEDGER)
          .withColumn("ts_utc", F.current_timestamp())
          .withColumn("error", F.substring("error", 1, ERROR_TEXT_MAX)))
    df.coalesce(1).write.mode("append").parquet(_newest(spark, path) or f"{path.rstrip('/')}/gen-000000")


def append_ledger(spark: SparkSession, path: str, service: str, year: int, month: int, status: str,
                  rows: int = 0, run_tag: str = "", error: str = "") -> None:
    """Append one attempt row."""
    append_attempts(spark, path, [(service, year, month, status, rows, run_tag, error)])


def ledger_files(spark: SparkSession, path: str) -> int:
    """Files that hold the ledger's rows."""
    now = _newest(spark, path)
    if now is None:
        return 0
    target, fs = _fs(spark, now)
    return sum(f.isFile() and not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(target))


def compact_ledger(spark: SparkSession, path: str, rows_per_file: int = 1_000_000) -> int:
    """All attempts as a new generation of few files, ordered by time; returns the number of
    files. Older generations than the one compacted go."""
    now = _newest(spark, path)
    if now is None:
        return 0
    before = _generations(spark, path)
    last = int(before[-1].rsplit("-", 1)[1]) if before else -1
    rows = read_ledger(spark, path)
    parts = max(1, -(-rows.count() // rows_per_file))
    rows.repartitionByRange(parts, "ts_utc", *KEYS).sortWithinPartitions("ts_utc", *KEYS).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/gen-{last + 1:06d}")
    for old in before[:-1]:
        target, fs = _fs(spark, old)
        fs.delete(target, True)
    return ledger_files(spark, path)


def month_grid(spark: SparkSession, services: Iterable[str], years: Iterable[int],
               months: Iterable[int] = range(1, 13)) -> DataFrame:
    """All (service, year, month) combinations of the job parameters (a small frame)."""
    rows = [(s, int(y), int(m)) for s in services for y in years for m in months]
    return spark.createDataFrame(rows, "service string, year int, month int")


def loaded(ledger: DataFrame, statuses: Iterable[str] = (OK,)) -> DataFrame:
    return ledger.where(F.col("status").isin(list(statuses))).select(*KEYS).distinct()


def pending_months(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """Wanted (service, year, month) without an OK attempt."""
    return wanted.join(loaded(ledger), KEYS, "left_anti")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Months and total rows per (service, status)."""
    return (ledger.groupBy("service", "status")
            .agg(F.count(F.lit(1)).alias("n_months"), F.sum("rows").alias("total_rows"))
            .orderBy("service", "status"))


def ledger_error_rate(ledger: DataFrame) -> DataFrame:
    """Attempted months per status as columns, their total and the error share (%)."""
    piv = (ledger.groupBy("service").pivot("status", [OK, ERROR])
           .agg(F.count(F.lit(1))).fillna(0, subset=[OK, ERROR]))
    total = F.col(OK) + F.col(ERROR)
    return (piv.withColumn("total_months", total)
            .withColumn("error_pct", F.round(F.lit(100.0) * F.col(ERROR) / F.nullif(total, F.lit(0)), 1))
            .orderBy("service"))


def format_rows(df: DataFrame, col: str = "total_rows") -> DataFrame:
    """Thousands separators for display."""
    return df.withColumn(col, F.format_number(F.col(col).cast(T.LongType()), 0))
