"""Tables that a warehouse exports as Arrow files, as a Spark data source of Python.

``spark.read.format("arrow_export").option("path", ...).option("table", ...)`` reads every file below
``path/table``; ``df.write.format("arrow_export")`` writes them. A large file is several partitions, by
ranges of its record batches. Of each batch only the declared columns' buffers are read, and filters
on whole numbers, texts, flags and dates are applied to it before rows leave the task. Writers leave hidden
files, which the commit renames, so a lost task or a failed write leaves nothing to read.
"""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

NAME = "arrow_export"
#: Bytes of a file that one partition reads, unless option ``split_bytes`` says otherwise.
SPLIT_BYTES = 128 << 20
SUFFIX = ".arrow"

_COMPARED = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
}
#: Types whose values compare alike here and in Spark.
_ALIKE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType, T.DateType)


def register(spark: SparkSession) -> None:
    """Make the source known to a session; its code travels to the executors with the plan."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArrowExport)


def _place(options: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    if not options.get("path"):
        raise ValueError("option 'path' is needed")
    uri = options["path"].rstrip("/")
    uri = uri if "://" in uri or uri.startswith("/") else uri.replace("file:/", "file:///", 1)
    system, root = pafs.FileSystem.from_uri(uri)
    table = options.get("table", "").strip("/")
    return system, f"{root}/{table}" if table else root


def _files(system: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    found = system.get_file_info(pafs.FileSelector(folder, recursive=True))
    data = [f for f in found if f.is_file and f.path.endswith(SUFFIX) and not f.base_name.startswith((".", "_"))]
    return sorted(data, key=lambda f: f.path)


@dataclass
class Batches(ds.InputPartition):
    """Record batches of one file: all of them where ``stop`` is None."""

    path: str
    start: int = 0
    stop: int | None = None


class ArrowExport(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        system, folder = _place(self.options)
        files = _files(system, folder)
        if not files:
            raise FileNotFoundError(f"no {SUFFIX} file below {folder}; declare a schema to read an empty table")
        with system.open_input_file(files[0].path) as source:
            return from_arrow_schema(pa.ipc.open_file(source).schema)

    def reader(self, schema: T.StructType) -> ArrowReader:
        return ArrowReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ArrowWriter:
        return ArrowWriter(dict(self.options), schema, overwrite)


class ArrowReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.declared, self.filters = options, schema, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:  # noqa: N802
        """Keep what Arrow decides as Spark would; the rest goes back."""
        for given in filters:
            name = given.attribute[0] if len(getattr(given, "attribute", ())) == 1 else None
            kind = self.declared[name].dataType if name in self.declared.names else None
            valued = isinstance(given, (*_COMPARED, ds.In)) and isinstance(kind, _ALIKE)
            if kind is not None and (valued or isinstance(given, (ds.IsNull, ds.IsNotNull))):
                self.filters.append(given)
            else:
                yield given

    def partitions(self) -> Sequence[Batches]:
        system, folder = _place(self.options)
        split = int(self.options.get("split_bytes", SPLIT_BYTES))
        found = []
        for file in _files(system, folder):
            if file.size <= split:
                found.append(Batches(file.path))
                continue
            with system.open_input_file(file.path) as source:
                batches = pa.ipc.open_file(source).num_record_batches
            step = max(1, batches * split // file.size)
            found += [Batches(file.path, k, min(batches, k + step)) for k in range(0, batches, step)]
        return found

    def read(self, partition: Batches) -> Iterator[pa.RecordBatch]:
        if not getattr(partition, "path", None):
            return  # a table without files
        system, _ = _place(self.options)
        wanted = to_arrow_schema(self.declared)
        with system.open_input_file(partition.path) as source:
            names = pa.ipc.open_file(source).schema.names
            absent = [n for n in wanted.names if n not in names]
            if absent:
                raise ValueError(f"{partition.path} has no column {absent}")
            chosen = pa.ipc.IpcReadOptions(included_fields=sorted(names.index(n) for n in wanted.names))
            reader = pa.ipc.open_file(source, options=chosen)
            stop = reader.num_record_batches if partition.stop is None else partition.stop
            for k in range(partition.start, stop):
                batch = reader.get_batch(k)
                batch = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in wanted], schema=wanted)
                yield _kept(batch, self.filters)


def _kept(batch: pa.RecordBatch, filters: list[ds.Filter]) -> pa.RecordBatch:
    """Rows for which every filter is true; an undecided one is not."""
    for given in filters:
        column = batch.column(given.attribute[0])
        if isinstance(given, ds.IsNull):
            mask = pc.is_null(column)
        elif isinstance(given, ds.IsNotNull):
            mask = pc.is_valid(column)
        elif isinstance(given, ds.In):
            known = pa.array([v for v in given.value if v is not None], column.type)
            mask = pc.and_(pc.is_in(column, known), pc.is_valid(column))
        else:
            value = given.value
            if isinstance(value, dt.datetime):
                value = value.date()
            mask = _COMPARED[type(given)](column, pa.scalar(value, column.type))
        batch = batch.filter(mask)
    return batch


@dataclass
class Written(ds.WriterCommitMessage):
    paths: list[str] = field(default_factory=list)


class ArrowWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.options, self.declared, self.overwrite = options, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One hidden file per task and attempt; none where there is no row."""
        system, folder = _place(self.options)
        path, writer, sink = f"{folder}/.{uuid.uuid4().hex}{SUFFIX}", None, None
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(folder, recursive=True)
                    sink = system.open_output_stream(path)
                    writer = pa.ipc.new_file(sink, batch.schema)
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Written([path] if writer is not None else [])

    def commit(self, messages: list[Written | None]) -> None:
        """Show the new files, then drop those they replace."""
        system, folder = _place(self.options)
        system.create_dir(folder, recursive=True)
        before = _files(system, folder) if self.overwrite else []
        for message in messages:
            for path in message.paths if message else []:
                hidden = path.rpartition("/")[2]
                system.move(path, f"{folder}/part-{hidden[1:]}")
        for file in before:
            system.delete_file(file.path)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = _place(self.options)
        for message in messages:
            for path in message.paths if message else []:
                if system.get_file_info(path).is_file:
                    system.delete_file(path)
