"""Session settings, and the shared folder for files that outlive a stage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Safe to set on a running session. Shuffle and scan sizes stay with the cluster:
# adaptive execution coalesces small shuffle partitions and splits skewed ones.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

PACKAGE = Path(__file__).resolve().parent

_scratch: set[str] = set()
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job here relies on: UTC, and adaptive execution."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(name: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def has_local_master(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master) is not None


def ship_package(spark: SparkSession) -> None:
    """Let Python workers find this package: once per application, whatever the driver's own path is;
    the archive is removed when the driver ends."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    folder = Path(tempfile.mkdtemp(prefix="trendloom-code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "trendloom_code.zip", "w") as code:
        for path in PACKAGE.rglob("*.py"):
            code.write(path, path.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(folder / "trendloom_code.zip"))
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    On a cluster it has to be set. A local master, where driver and executors are one process,
    gets a folder of its own where it is unset, which is removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not has_local_master(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="trendloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one; it is removed when the application ends."""
    root = f"{shared_folder(spark)}/trendloom-{spark.sparkContext.applicationId}"
    if root not in _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _scratch.add(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for a table of this application; nothing is created yet."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
