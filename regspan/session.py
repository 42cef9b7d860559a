"""Session settings the operators are written for."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Runtime settings; all of them are Spark defaults or safe to set on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Registers in different numbers of buckets are joined in the smaller number.
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
}

# Temporary folders of this process, by application.
_own_folders: dict[str, str] = {}


def local_session(cores: int = 8, app: str = "regspan", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        # Small test tables should still use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On one machine (a ``local[…]`` master) a temporary folder takes its place where the
    setting is missing; it is deleted when Python ends. Anywhere else a missing
    setting is an error: executors do not share a local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="regspan-")
        atexit.register(shutil.rmtree, _own_folders[app], ignore_errors=True)
    return _own_folders[app]


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; ``release`` deletes it."""
    return f"{shared_folder(spark)}/regspan-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete what this application has written below the shared folder.

    Frames made from it can no longer be read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
