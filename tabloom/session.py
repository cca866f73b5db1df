"""Session defaults and the shared folder used for materialised results."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tabloom", **conf: str) -> SparkSession:
    """A session for tests and local benches; a cluster brings its own settings."""
    n = os.cpu_count() or 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


#: What this process has written for its own use, and the folder of its own that a local master falls back to.
_MADE: list[str] = []
_LOCAL: list[str] = []


def _local_folder() -> str:
    """A temporary folder of this process, which goes with it."""
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tabloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder, which is removed when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    _MADE.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def drop_written(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has written so far, once results that rest on them have been read; how many."""
    dropped = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped
