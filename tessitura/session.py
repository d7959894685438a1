"""Session defaults used by the tests, the bench and local runs."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tessitura", memory: str = "12g") -> SparkSession:
    """A local session for tests and bench; a cluster supplies its own settings."""
    parallel = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Column call sites are not recorded; with large plans that halves planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever the session was started.

    Once per Spark application; the archive goes through Spark's own file server.
    """
    context = spark.sparkContext
    if getattr(context, "_tessitura_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/tessitura", "zip", package.parent, package.name)
        context.addPyFile(archive)
    context._tessitura_shipped = True
