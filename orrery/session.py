"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "orrery",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE on and the UI off. ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset
    (local tests), a folder beside the tables of ``spark.sql.warehouse.dir``,
    which every session shares with its executors."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside = threading.Lock(), []


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside go with the end of each, not when
    the driver happens to collect its plans: for plans that run once. Threads
    may be inside together; the last one out restores the setting."""
    with _lock:
        if not _inside:
            shuffles_dropped.before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _inside.append(1)
    try:
        yield
    finally:
        with _lock:
            _inside.pop()
            if not _inside and shuffles_dropped.before is None:
                spark.conf.unset(_CLEANUP)
            elif not _inside:
                spark.conf.set(_CLEANUP, shuffles_dropped.before)


def written(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder (to ``path`` in it) and
    read back: lineage and shuffle files end there, and repeated values take
    little room."""
    path = path or scratch_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df):
    """Reliable checkpoint to the shared folder (never ``localCheckpoint``):
    survives executor loss. The input is persisted for the duration so the
    checkpoint write does not recompute it."""
    checkpoint_dir(df.sparkSession)
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
