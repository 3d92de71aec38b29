"""Spark session helpers.

The library never builds its own session inside an operator: every
operator takes DataFrames in and hands DataFrames back.  These helpers
exist for scripts, tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  The session zone must be
# UTC so that date/timestamp formatting inside hash keys is stable across
# machines; AQE re-plans joins from runtime sizes (the size check behind
# every broadcast that is not a fixed literal table).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "vaultmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; a
    missing setting is an error there.  Only on a local master (tests) is a
    scratch folder created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="vaultmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[int, list] = {}                 # session -> [jobs inside ``shuffles_dropped``, its setting outside]
_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs started inside remove their shuffle files when they end, so that the next job has the disk.  For jobs whose
    result is written: their shuffles are never read again (a frame that is run twice would have to make them anew)."""
    at = spark._jsparkSession.hashCode()        # a stream's batches have a session of their own
    with _LOCK:
        _CLEANING.setdefault(at, [0, spark.conf.get(FILE_CLEANUP, None)])[0] += 1
        spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            _CLEANING[at][0] -= 1
            if not _CLEANING[at][0]:
                before = _CLEANING.pop(at)[1]
                spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def _written(spark: SparkSession, df, name: str) -> str:
    import uuid
    path = scratch_path(spark, f"materialized/{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts the lineage so several consumers do not recompute it.  The
    shuffles behind it are removed once it is written."""
    return spark.read.parquet(_written(spark, df, name))


@contextmanager
def materialized(spark: SparkSession, df, name: str):
    """``materialize`` for as long as the block runs: the files are deleted at its end."""
    path = _written(spark, df, name)
    try:
        yield spark.read.parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize_all(spark: SparkSession, tables: dict, at_once: int = 6) -> dict:
    """``materialize`` for each table, a few at a time: small tables do not wait for one another."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(lambda k: materialize(spark, tables[k], k), tables)))
