"""JDBC source and sink (any database with a JDBC driver on the classpath)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, props: Mapping[str, str] | None = None) -> DataFrame:
    """Read the result of a query pushed to the database."""
    r = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def table_count(spark: SparkSession, url: str, table: str, props: Mapping[str, str] | None = None) -> int:
    """COUNT(*) computed by the database; one row comes back."""
    return int(read_query(spark, url, f"SELECT COUNT(*) AS n FROM {table}", props).first()[0])


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", writers: int = 4,
                batchsize: int = 5000, props: Mapping[str, str] | None = None) -> None:
    """Batch insert through ``writers`` parallel connections."""
    w = (df.coalesce(writers).write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize)).mode(mode))
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()
