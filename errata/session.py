"""Sessions, and what a session needs to run the library's Python functions on executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, use the cluster's own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("errata")
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the one that driver and executors share, named in spark.checkpoint.dir. Only a
    local session without that setting gets a folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="errata-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/errata/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each session's context, so that they can import it."""
    context = spark.sparkContext
    if getattr(context, "_errata_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="errata-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(os.path.join(folder, f"errata-{os.getpid()}"), "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._errata_shipped = True
