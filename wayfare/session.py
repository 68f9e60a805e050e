"""Session settings and the checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


ROOT = Path(__file__).resolve().parents[1]
ARCHIVE = "wayfare-package.zip"
# Shuffled bytes a task should get.
BYTES_PER_PARTITION = 128 << 20


def build_session(app: str = "wayfare", master: str | None = None, shuffled_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with adaptive execution on.

    ``shuffled_bytes`` is the size of the largest shuffle expected; it sets how many partitions
    shuffles start with, which adaptive execution then merges where they turn out small.
    ``conf`` sets anything else.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the call site of every expression doubles the time to build a query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffled_bytes:
        partitions = max(8, -(-shuffled_bytes // BYTES_PER_PARTITION))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once a session, where their Python could not find it."""
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(ROOT) in found or any(Path(f).name == ARCHIVE for f in spark.sparkContext.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="wayfare-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{Path(ARCHIVE).stem}", "zip", ROOT, "wayfare"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without one gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="wayfare-checkpoint-"))
    return sc.getCheckpointDir()
