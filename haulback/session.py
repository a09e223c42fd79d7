"""Session settings and the shared-folder cut used between long stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A skewed join must be split even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call sites recorded for every column expression cost more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

# Off a single machine: many small shuffle partitions to start with, merged by AQE up to a size
# that fits an executor core's memory; scans cut to the same size. AQE never splits an ordinary
# shuffle partition: where a shuffle exceeds 5 TB, set a count of its bytes over 256 MB.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str = "haulback", master: str | None = None, settings: dict | None = None) -> SparkSession:
    """A session with the settings the plans are written for.

    ``settings`` wins over the defaults. On a cluster set ``spark.checkpoint.dir`` to a folder
    every executor can reach; :func:`materialize` writes there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = SESSION_SETTINGS if (master or "").startswith("local") else {**SESSION_SETTINGS, **CLUSTER_SETTINGS}
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Says that a ``file:`` checkpoint folder on a cluster is a mount that all machines share.
SHARED_MOUNT = "spark.haulback.sharedMount"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode.

    On a cluster a ``file:`` folder is refused, each machine having its own, unless ``SHARED_MOUNT`` is true.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and folder.startswith("file:") and spark.conf.get(SHARED_MOUNT, "false") != "true":
            raise RuntimeError(f"{folder} is a folder of each machine; name a shared one, or set {SHARED_MOUNT}")
        return folder.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="haulback-"))
    return spark.sparkContext.getCheckpointDir()


_watchers: list[list[tuple[DataFrame, str]]] = []


@contextmanager
def watch_written() -> Iterator[list[tuple[DataFrame, str]]]:
    """Collects every frame that :func:`materialize` writes meanwhile, with its path."""
    written: list[tuple[DataFrame, str]] = []
    _watchers.append(written)
    try:
        yield written
    finally:
        _watchers.remove(written)


def delete_written(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of :func:`materialize`, wherever the shared folder is."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        where = hadoop.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/haulback/{label}-{uuid.uuid4().hex}"


#: Whether rows laid out by some of a join's keys are moved again before it; by default they are.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


#: Whether the shuffle files of a query are deleted when it ends, instead of whenever the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that a Python task is handed at once: by default so many that whole texts are tens of MB, in the JVM and in Python.
ARROW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextmanager
def _with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialize(df: DataFrame, label: str, keep_layout: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where several outputs share one expensive input. The written table survives the loss of
    any executor, later readers prune its columns, and its known size lets Catalyst decide
    statically whether it is small enough to broadcast.

    With ``keep_layout``, rows laid out by some of a join's keys, e.g. by vessel for one on vessel and date, meet the
    other side where they are; for keys that are spread well enough by themselves. ``compression`` replaces the session's.
    Once the table is written, the shuffle files behind it are deleted: nothing reads them any more. Python tasks are
    handed ``ARROW_ROWS`` at once meanwhile.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for written in _watchers:
        written.append((df, path))
    with _with_settings(spark, {FREED: "true"} | ARROW_ROWS | ({ALL_KEYS: "false"} if keep_layout else {})):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
