"""Parquet table sinks: full rebuild, append, partition replace, partition probe.

Partition replace uses dynamic partition overwrite: only the partitions present in
the written DataFrame are replaced, everything else is untouched.

Partitioned writes are clustered first: ``REBALANCE`` by the partition columns brings the
rows of a partition together (adaptive execution splits a large one into files of the
advisory size and joins small ones), and rows are sorted by time within a file, so that the
row groups' statistics let later time and range filters skip most of them.

Counts of stored tables come from Parquet footers: the aggregate is pushed into the scan,
and no column is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WIDE_PARTITIONS = ("source_year", "service_type")
#: Columns that files are sorted by, where a table has them.
TIME_COLUMNS = ("pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds a table; any other trouble (access, damaged
    files) is an error and not an absent table."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    return any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(target))


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] = WIDE_PARTITIONS, dynamic: bool = False, clustered: bool = False) -> int:
    """Write ``df`` and return its row count, counted in the same pass (``observe``).
    ``clustered``: the rows of a partition lie together already (``build_wide``)."""
    return _write_counted(df, path, mode, partition_by, dynamic, {}, clustered)["rows"]


def _write_counted(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], dynamic: bool, also: dict,
                   clustered: bool = False) -> dict:
    """Write and count, all rows and those under each condition in ``also``, in one pass."""
    obs = Observation("written")
    if partition_by:
        order = [c for c in TIME_COLUMNS if c in df.columns]
        if not clustered:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df = df.sortWithinPartitions(*partition_by, *order)
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in also.items()])
    w = counted.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return {k: int(v or 0) for k, v in obs.get.items()}


def full_rebuild(df: DataFrame, path: str, overwrite: bool,
                 partition_by: Sequence[str] = WIDE_PARTITIONS, clustered: bool = False) -> int:
    """Full mode: replace the whole table when ``overwrite``, else append (a rerun
    appends duplicates, as in the original job)."""
    return write_table(df, path, "overwrite" if overwrite else "append", partition_by, clustered=clustered)


def footer_counts(spark: SparkSession, path: str, keys: Sequence[str] = (), only: Iterable[tuple] | None = None) -> DataFrame:
    """Rows of a stored Parquet table, per value of its partition columns ``keys``, from the
    files' footers (the count is pushed into the scan). ``only`` prunes to some partitions.

    The frame belongs to a session of its own whose settings read Parquet by the source that
    pushes aggregates down; the caller's session keeps its settings.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    t = own.read.parquet(path)
    if only is not None:
        t = t.where(any_partition(keys, only))
    return t.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def any_partition(keys: Sequence[str], wanted: Iterable[tuple]):
    """Condition: the row is in one of the ``wanted`` partitions."""
    cond = F.lit(False)
    for w in wanted:
        cond = cond | _is_partition(keys, w)
    return cond


def existing_partitions(spark: SparkSession, path: str, keys: Sequence[str] = WIDE_PARTITIONS,
                        only: Iterable[tuple] | None = None) -> DataFrame:
    """Row count per existing partition, from footers; with ``only`` the filter on partition
    columns prunes the listing to those partitions."""
    schema = ", ".join(f"{k} {'int' if k.endswith('year') else 'string'}" for k in keys) + ", rows long"
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r) for r in footer_counts(spark, path, keys, only).collect()], schema)   # a row a partition


def partition_replace(spark: SparkSession, df: DataFrame, path: str, wanted: Iterable[tuple],
                      overwrite: bool, keys: Sequence[str] = WIDE_PARTITIONS, clustered: bool = False) -> dict:
    """By-partition mode: for each wanted partition, skip it when it already has rows
    (unless ``overwrite``), else (re)write it. One Spark job writes all of them. The wanted
    partitions are a plain condition, which reaches the sources of ``df``: other services
    and years are left out before they are joined and widened.

    A wanted partition that has no source rows any more is emptied: its old files go.

    Returns ``{"written": rows, "skipped": [...], "replaced": [...], "new": [...],
    "emptied": [...]}``.
    """
    wanted = [tuple(w) for w in wanted]
    have = {tuple(r[:len(keys)]): r["rows"] for r in existing_partitions(spark, path, keys, wanted).collect()}
    skipped = [w for w in wanted if have.get(w, 0) > 0 and not overwrite]
    todo = [w for w in wanted if w not in skipped]
    if not todo:
        return {"written": 0, "skipped": skipped, "replaced": [], "new": [], "emptied": []}
    part = df.where(any_partition(keys, todo))
    hit = {f"w{i}": _is_partition(keys, w) for i, w in enumerate(todo)}
    got = _write_counted(part, path, "overwrite", keys, True, hit, clustered)
    rows = {w: got[f"w{i}"] for i, w in enumerate(todo)}
    emptied = [w for w in todo if have.get(w, 0) > 0 and not rows[w]]
    for w in emptied:
        _drop_partition(spark, path, keys, w)
    return {"written": got["rows"], "skipped": skipped, "emptied": emptied,
            "replaced": [w for w in todo if have.get(w, 0) > 0 and rows[w]],
            "new": [w for w in todo if have.get(w, 0) == 0 and rows[w]]}


def _is_partition(keys: Sequence[str], values: tuple):
    cond = F.lit(True)
    for k, v in zip(keys, values):
        cond = cond & (F.col(k) == F.lit(v))
    return cond


def _drop_partition(spark: SparkSession, path: str, keys: Sequence[str], values: tuple) -> None:
    """Delete the folders that hold the rows of one partition."""
    rows = spark.read.parquet(path).where(_is_partition(keys, values))
    files = rows.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("dir")).distinct()
    for r in files.collect():          # one folder per partition
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(r["dir"])
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# ------------------------------------------------------------------ catalog


def ensure_table(spark: SparkSession, name: str, schema, path: str, partition_by: Sequence[str] = WIDE_PARTITIONS) -> None:
    """Create the database and the external partitioned table ``name`` (database.table) if
    they are missing; an existing table is left as it is. Columns are the declared ones."""
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{c}`" for c in partition_by)
    clustered = f" PARTITIONED BY ({by})" if by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{clustered} LOCATION '{path}'")


def register_partitions(spark: SparkSession, name: str, path: str, keys: Sequence[str] = WIDE_PARTITIONS) -> dict:
    """Make the catalog list exactly the partitions that the table's folder holds: new ones
    are added, emptied ones dropped (their files are gone already). A second call changes
    nothing. Returns the partitions {"added": [...], "dropped": [...]}."""
    listed = {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    held = set()
    if table_exists(spark, path):
        held = {tuple(str(v) for v in r[:len(keys)]) for r in footer_counts(spark, path, keys).collect()}
    spec = lambda w: "PARTITION (" + ", ".join(f"`{k}`='{v}'" for k, v in zip(keys, w)) + ")"
    added, dropped = sorted(held - listed), sorted(listed - held)
    if added:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(spec(w) for w in added))
    for w in dropped:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec(w)}")
    spark.catalog.refreshTable(name)
    return {"added": added, "dropped": dropped}
