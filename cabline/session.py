"""Session helpers: a local session for tests/bench and a shared scratch location."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_WRITTEN: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cabline") -> SparkSession:
    """Session for tests and the bench; a cluster job gets its session from spark-submit."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session (tests, bench) that names none gets a private folder; on a cluster
    a machine-local folder would lose files, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^,\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="cabline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint location for a written table; it is
    removed when the driver ends, or earlier by ``drop_path``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _WRITTEN:
        atexit.register(_drop_all, spark)
    _WRITTEN.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that no later step reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


@contextlib.contextmanager
def written_tables():
    """Yields a list that holds, after the block, the scratch tables it wrote and kept."""
    before, paths = set(_WRITTEN), []
    yield paths
    paths.extend(p for p in _WRITTEN if p not in before)


def _drop_all(spark: SparkSession) -> None:
    for path in list(_WRITTEN):
        with contextlib.suppress(Exception):   # the session may have been stopped before
            drop_path(spark, path)


def materialize_at(df, name: str):
    """``materialize`` that also returns the folder, for ``drop_path``."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), path


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a Parquet table under the shared checkpoint
    folder and reading it back (columnar, so later passes keep column pruning)."""
    return materialize_at(df, name)[0]
