"""The session settings that the library's results rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that change results; every one of them is a session setting, so they can be put on a running session.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: nothing to do where they inherit a path to it, else it goes to the executors as an archive, once."""
    sc, package = spark.sparkContext, Path(__file__).parent
    root = str(package.parent)
    inherited = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in inherited or sc.master.startswith("local[") and os.getcwd() == root or getattr(sc, "_tidemark_shipped", False):
        return
    folder = tempfile.mkdtemp(dir=sc._temp_dir)  # executors fetch it from the driver; it goes with the application
    sc.addPyFile(shutil.make_archive(f"{folder}/tidemark", "zip", root, package.name))
    sc._tidemark_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    """Put the result-changing settings on an existing session, and the package on its executors."""
    ship(spark)
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    settings = RESULT_CONF | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
