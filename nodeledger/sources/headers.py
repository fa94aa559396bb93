"""The first line of many files, without reading the rest of any.

Spark lists the files, each task opens its own and stops at the first line break. Files of a store
that only Spark can open are left to a pass over the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes read at a time; more are read only where the first line is longer.
PIECE = 1 << 14


def first_line(stream) -> str | None:
    """The first line of an open byte stream without its break; ``None`` if the file is empty."""
    begin = b""
    while piece := stream.read(PIECE):
        begin += piece
        if b"\n" in piece or b"\r" in piece:
            break
    if not begin:
        return None
    return begin.split(b"\n", 1)[0].split(b"\r", 1)[0].decode("utf-8", "replace")


def _open(path: str):
    """A stream of a file's bytes, unpacked if its name ends with .gz."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/@?=&"))
    return store.open_input_stream(name, compression="gzip" if name.endswith(".gz") else None)


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, opened = [], []
        for path in batch.column(0).to_pylist():
            try:
                with _open(path) as stream:
                    lines.append(first_line(stream))
                opened.append(True)
            except (OSError, ValueError, ImportError, pa.ArrowException):  # a store that pyarrow doesn't know or reach here
                lines.append(None)
                opened.append(False)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string()), pa.array(opened)], names=["path", "header", "opened"])


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def first_lines(spark: SparkSession, folder: str, pattern: str, wanted) -> DataFrame:
    """(path, header, opened) of the files in a folder whose name fits ``pattern`` and ``wanted``.

    The listing has the content of no file, but deals files to tasks by their size, large ones
    alone. ``header`` is null for an empty file and for one that wasn't ``opened``.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return listed.filter(wanted(file_name(F.col("path")))).mapInArrow(_headers, "path string, header string, opened boolean")


def first_lines_by_scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header) by a pass over the whole text: for stores that only Spark opens."""
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.filter(F.col("at") == 0).groupBy("path").agg(F.min_by("value", "line").alias("header"))
