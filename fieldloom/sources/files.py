"""Binary files in any store: read by Spark, written from the tasks by pyarrow file systems."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession


def read_binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content) of all files below a folder, or of one file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def write_binary(files: DataFrame, folder: str) -> int:
    """Write rows (file, content) below ``folder``, one task per partition; a file appears under its name only when whole.

    Returns the number of files.  A plain path must be shared by all executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), os.path.abspath(folder))
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                target = f"{base}/{name}"
                fs.create_dir(os.path.dirname(target), recursive=True)
                with fs.open_output_stream(target + ".part") as out:
                    out.write(content.as_buffer())
                fs.move(target + ".part", target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return files.select("file", "content").mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0
