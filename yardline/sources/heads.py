"""Headers of delimited files, found in the first bytes of each file.

Only a bounded head is fetched, by the session's own file systems, so that finding headers costs one short
read per file and the data are scanned once. What the driver holds are these heads, one after the other.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Bytes in which a file's header must end, and files asked for at the same time.
HEAD_BYTES = 1 << 16
AT_ONCE = 16


@dataclass(frozen=True)
class Head:
    """A file's header: its cells, and the lines down to it, itself included, as they stand."""

    cells: tuple[str, ...]
    lines: tuple[str, ...]

    @property
    def above(self) -> int:
        return len(self.lines) - 1


def first_lines(spark: SparkSession, uri: str, limit: int = HEAD_BYTES) -> list[str]:
    """Whole lines within the first bytes of a file, unpacked if its name tells a codec."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        unpacked = stream if codec is None else codec.createInputStream(stream)
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(unpacked, limit)))
    finally:
        stream.close()
    lines = data.decode("utf-8", "replace").splitlines()
    return lines if len(data) < limit else lines[:-1]


def plain_cells(sep: str) -> Callable[[str], list[str]]:
    """Cells of a line without quoted separators."""
    return lambda line: [cell.strip(' "\r\ufeff') for cell in line.split(sep)]


def quoted_cells(sep: str) -> Callable[[str], list[str]]:
    return lambda line: [cell.strip() for cell in next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])]


def find_heads(
    spark: SparkSession, files: Iterable[str], columns: Collection[str], cells: Callable[[str], list[str]]
) -> dict[str, Head]:
    """For each file the first line of its head that names all columns; files without one are left out."""

    def head(uri: str) -> Head | None:
        lines = first_lines(spark, uri)
        for k, line in enumerate(lines):
            found = cells(line)
            if set(columns) <= set(found):
                return Head(tuple(found), tuple(lines[: k + 1]))
        return None

    files = sorted(set(files))
    with ThreadPoolExecutor(AT_ONCE) as pool:
        heads = list(pool.map(inheritable_thread_target(spark)(head), files))
    return {uri: found for uri, found in zip(files, heads, strict=True) if found is not None}
