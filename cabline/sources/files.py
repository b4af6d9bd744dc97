"""File sources: monthly trip files and the zone CSV."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline import schemas
from cabline.sources.conform import conform_schema, normalize_headers

# Fixed value: monthly file naming, e.g. yellow_tripdata_2024-01.parquet
FILE_PATTERN = "{service}_tripdata_{year}-{month:02d}.parquet"
_PATH_RE = r"([a-z]+)_tripdata_(\d{4})-(\d{2})\.parquet"


def source_path(base: str, service: str, year: int, month: int) -> str:
    return f"{base.rstrip('/')}/{FILE_PATTERN.format(service=service, year=year, month=month)}"


def read_month(spark: SparkSession, base: str, service: str, year: int, month: int) -> DataFrame:
    """One monthly file as it is (its own, possibly drifted, schema)."""
    return spark.read.parquet(source_path(base, service, year, month))


def read_months(spark: SparkSession, paths: Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    """Many monthly files of one schema generation in ONE scan; service/year/month come
    from each row's file name (``_metadata.file_path``), so no per-file driver loop."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*list(paths))
    fp = F.col("_metadata.file_path")
    return df.withColumns({
        "_file_service": F.regexp_extract(fp, _PATH_RE, 1),
        "_file_year": F.regexp_extract(fp, _PATH_RE, 2).cast("int"),
        "_file_month": F.regexp_extract(fp, _PATH_RE, 3).cast("int"),
    })


def read_zones_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Zone lookup CSV with a header; headers normalised, then conformed to ZONES."""
    reader = spark.read.option("header", True)
    if infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.csv(path)
    return conform_schema(normalize_headers(df), schemas.ZONES, tolerant=True)
