"""Cutting a plan at a result that several later steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, registered with Spark.

    Only a local session without one gets a folder of its own: a cluster must name a shared one.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="nodeledger-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
