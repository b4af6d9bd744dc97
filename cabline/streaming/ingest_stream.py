"""Incremental raw ingestion as a Structured Streaming file source.

The file source's checkpoint remembers which monthly files were processed, which is
the streaming form of "skip months already loaded". A month may come in several files, in
one micro-batch, over several, or late: every micro-batch adds its rows to the month.

Each micro-batch is conformed, stamped with lineage (year/month from each file's name) and
written under partitions of its own, ``source_year / source_month / ingest_batch``. The batch
name is made of the checkpoint and the epoch, so a batch that is run again after a failure
replaces exactly what it wrote before, and nothing else: every row lands once. Ledger rows
(one per month of a batch, tagged with the batch) are appended after the data commit, unless
an earlier run of the same batch has done so; their sums equal the table's rows.

``availableNow`` processes everything new and stops, so the job runs as a batch.
A stream reads one declared file layout; drifted generations whose column types
clash at the Parquet reader go through the batch job (``plans.ingest``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline import schemas
from cabline.sources import ledger as LG
from cabline.sources import sinks
from cabline.sources.conform import conform_schema, utc_now
from cabline.sources.files import _PATH_RE

PARTITIONS = ("source_year", "source_month", "ingest_batch")


def batch_name(checkpoint: str, epoch: int) -> str:
    """Name of a micro-batch, the same whenever it is run."""
    return f"{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{epoch:08d}"


def land_batch(batch: DataFrame, target: str, ledger_path: str, service: str, run_tag: str, name: str) -> None:
    """Write one micro-batch and its ledger rows; running it again changes nothing."""
    spark = batch.sparkSession
    stamped = batch.withColumn("ingest_batch", F.lit(name))
    if not sinks.write_table(stamped, target, "overwrite", PARTITIONS, dynamic=True):
        return
    written = sinks.footer_counts(spark, target, PARTITIONS).where(F.col("ingest_batch") == name).collect()   # a row a month
    tag = f"{run_tag}#{name}"
    known = {(r["year"], r["month"]) for r in LG.read_ledger(spark, ledger_path).where(
        (F.col("service") == service) & F.col("run_tag").endswith(f"#{name}")).collect()}
    LG.append_attempts(spark, ledger_path, [
        (service, r["source_year"], r["source_month"], LG.OK, r["rows"], tag, None)
        for r in written if (r["source_year"], r["source_month"]) not in known])


def start(spark: SparkSession, source_dir: str, service: str, out: str, ledger_path: str, checkpoint: str,
          run_tag: str, max_files_per_trigger: int = 12):
    schema = schemas.RAW_BY_SERVICE[service]
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(f"{source_dir.rstrip('/')}/{service}_tripdata_*"))
    fp = F.col("_metadata.file_path")
    stamped = conform_schema(stream, schema, tolerant=True).withColumns({
        "run_tag": F.lit(run_tag),
        "source_year": F.regexp_extract(fp, _PATH_RE, 2).cast("int"),
        "source_month": F.regexp_extract(fp, _PATH_RE, 3).cast("int"),
        "ingested_at_utc": utc_now(),
        "service_type": F.lit(service),
    })
    target = f"{out.rstrip('/')}/{service}"

    def write_batch(batch: DataFrame, epoch: int) -> None:
        land_batch(batch, target, ledger_path, service, run_tag, batch_name(checkpoint, epoch))

    return (stamped.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
