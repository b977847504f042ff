"""Small expressions and helpers that several text operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import yardline
from yardline.session import materialise, scratch_dir

__all__ = ["SEPARATORS", "map_batches", "materialise", "read_table", "scratch_dir", "ship_package", "temp_name", "text_slices", "words"]

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text (null: none), white space being ``SEPARATORS`` only."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def temp_name(stem: str) -> str:
    """A column name that input columns do not clash with."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


#: Bytes of text that a task takes from an Arrow batch at a time.
SLICE_BYTES = 1 << 19


def text_slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``size`` bytes together; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's modules to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(yardline.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="yardline-"), "yardline.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("yardline", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def map_batches(
    frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(run, schema)
