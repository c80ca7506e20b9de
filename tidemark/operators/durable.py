"""Intermediate tables that survive lost executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a temporary one is set, in local mode only."""
    sc = spark.sparkContext
    if folder := sc.getConf().get("spark.checkpoint.dir"):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


#: With it, Spark deletes a query's shuffle files as soon as the query ends; without, when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files behind. The session's setting is as before afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """The same rows, cut from their lineage by a checkpoint in the shared folder. The checkpoint is all that stays on disk."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
