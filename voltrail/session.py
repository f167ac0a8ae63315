"""Session and shared work folder."""

from __future__ import annotations

import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(name: str = "voltrail", **conf: str) -> SparkSession:
    """A session pinned to UTC; days and keys of instants depend on the zone."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        # Column call sites are for debugging; recording them slows plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def qualify(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, so every executor opens the same place."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def discard(spark: SparkSession, workdir: str) -> None:
    """Deletes a folder that `new_workdir` gave."""
    if "/voltrail/" not in workdir:
        raise ValueError(f"{workdir} is no work folder")
    fs, hadoop_path = _hadoop(spark, workdir)
    fs.delete(hadoop_path, True)


def claim(spark: SparkSession, path: str, stale_seconds: float) -> bool:
    """Makes a file that only one caller can make; False where another has it.

    One that is older than `stale_seconds` is taken over: its maker is lost.
    """
    fs, hadoop_path = _hadoop(spark, path)
    try:
        if time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000 < stale_seconds:
            return False
        fs.delete(hadoop_path, False)
    except Py4JJavaError as error:
        if "FileNotFoundException" not in str(error.java_exception):
            raise
    try:
        fs.create(hadoop_path, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception):
            raise
        return False
    return True


def release(spark: SparkSession, path: str) -> None:
    """Takes away what `claim` made."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, False)


def new_workdir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="voltrail-")
    return qualify(spark, f"{shared.rstrip('/')}/voltrail/{label}-{uuid.uuid4().hex}")


def task_count(spark: SparkSession) -> int:
    """Partitions for shuffles that Spark does not resize: those that feed file work.

    They move small rows that stand for much work, so their bytes say nothing.
    """
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, 2 * spark.sparkContext.defaultParallelism)
