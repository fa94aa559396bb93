"""Cut lineage into the folder that the whole cluster shares."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one gets a folder of this machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return _LOCAL


_LOCAL: str | None = None


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint of a small, often reread intermediate result."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str, compression: str = "zstd", group_mb: int = 128) -> DataFrame:
    """The rows as a compressed, column-pruned table in the shared folder.

    Writers and readers hold a row group of ``group_mb`` in memory: fewer for rows of megabytes.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).option("parquet.block.size", group_mb << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hand_back() -> None:
    """Give memory that a task no longer needs back to the machine.

    Python workers are reused: without this a stage keeps what the largest task of an earlier one
    took. Where the C library can't trim its heap, nothing happens.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass
