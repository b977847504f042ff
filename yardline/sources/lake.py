"""The layered lake: path resolution, Parquet and CSV writes, dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Literal
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.session import materialise
from yardline.tables import INGESTION_DATE

# The layers.
LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Lake:
    """``root`` is any Hadoop file-system URI; ``layer_roots`` overrides single layers."""

    root: str
    layer_roots: dict[str, str] = field(default_factory=dict)

    def path(self, layer: str, dataset: str) -> str:
        if layer not in LAYERS:
            raise KeyError(f"unknown layer {layer!r}; known: {LAYERS}")
        base = self.layer_roots.get(layer) or f"{self.root.rstrip('/')}/{layer}"
        return f"{base.rstrip('/')}/{dataset}"

    def read(
        self, spark: SparkSession, layer: str, dataset: str, schema: T.StructType | None = None
    ) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self.path(layer, dataset))

    def read_newest(
        self,
        spark: SparkSession,
        layer: str,
        dataset: str,
        as_of: str | None = None,
        schema: T.StructType | None = None,
    ) -> DataFrame:
        """The newest dated snapshot, not later than ``as_of``.

        Only that one folder is opened. A table written without dates is read whole.
        """
        path = self.path(layer, dataset)
        prefix = f"{INGESTION_DATE}="
        children = child_names(spark, path)
        if children is None:
            raise FileNotFoundError(f"no table at {path}")
        dates = [c[len(prefix) :] for c in children if c.startswith(prefix)]
        reader = spark.read if schema is None else spark.read.schema(schema)
        if not dates:
            return reader.parquet(path)
        usable = [d for d in dates if as_of is None or d <= as_of]
        if not usable:
            raise FileNotFoundError(f"no snapshot of {path} up to {as_of}")
        folder = f"{path}/{prefix}{max(usable)}"
        return reader.option("basePath", path).parquet(folder)


def child_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below a folder on any Hadoop file system; None if it is absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    count_into: Observation | None = None,
    replace: Literal["all", "partitions"] = "all",
) -> None:
    """Write a layer table.

    Partitioned output is rebalanced on the partition columns: small shuffle
    partitions are merged into few files and a partition value holding much of
    the table is split over many tasks, so neither small files nor one huge task
    result. ``sort_by`` orders rows inside each file for tighter column statistics.
    ``count_into`` takes the number of rows, counted by the writing tasks: unlike a count
    before a shuffle it stays right when a lost executor's map tasks run again.
    ``replace="partitions"`` overwrites only the partitions that have rows here.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    if count_into is not None:
        df = df.observe(count_into, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static" if replace == "all" else "dynamic").parquet(path)


# --- changed partitions -----------------------------------------------------------------

CHECKSUMS = "_checksums"
_CHECKSUM_SCHEMA = "folder string, rows bigint, total decimal(38,0), parity bigint, columns string, files array<string>"


@dataclass(frozen=True)
class Changes:
    """What ``write_changed`` did, by folder name, and the rows the table has now."""

    written: list[str]
    kept: list[str]
    removed: list[str]
    rows: int


def write_changed(df: DataFrame, path: str, partition_by: str, sort_by: Sequence[str] = ()) -> Changes:
    """Bring a partitioned table to the rows of ``df``, rewriting only partitions that differ.

    The result is computed once, into the scratch folder. Each partition's row count and two sums of row hashes
    are compared with those kept beside the table, which also name its files: a partition whose files
    are not the recorded ones counts as changed, so a broken run or a foreign write mends itself. Changed partitions are
    replaced together by one dynamic overwrite; files of all others keep their names. The driver sees a row per partition.
    A table that is not there yet has nothing to be compared with: it is written in its place and summed from there.
    """
    spark, names = df.sparkSession, sorted(df.columns)
    # Text is staged in any case, since a folder's name does not tell empty text from null.
    new = child_names(spark, path) is None and isinstance(df.schema[partition_by].dataType, T.IntegralType)
    if new:
        write_parquet(df, path, partition_by=[partition_by], sort_by=sort_by)
        staged = spark.read.schema(df.schema).parquet(path)
    else:
        staged = materialise(df, "changed")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    # Spark keeps empty text and null in one folder.
    value = F.nullif(F.col(f"`{partition_by}`").cast("string"), F.lit(""))
    sums = staged.groupBy(value.alias("value")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row.cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(row, F.lit(1))).alias("parity"),
    )
    columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(staged.schema, key=lambda f: f.name))
    wanted = {partition_folder(partition_by, r["value"]): (r["value"], r["rows"], r["total"], r["parity"], columns) for r in sums.collect()}
    there = [] if new else [c for c in child_names(spark, path) or [] if not c.startswith(("_", "."))]
    foreign = any(not c.startswith(f"{partition_by}=") for c in there)
    known = {} if foreign else _checksums(spark, path)
    same = [f for f, told in wanted.items() if known.get(f) == (*told[1:], _file_names(spark, f"{path}/{f}"))]
    changed = sorted(set(wanted) - set(same))
    gone = [] if foreign else sorted(set(there) - set(wanted))
    if not new and (changed or foreign or child_names(spark, path) is None):
        values = [wanted[f][0] for f in changed]
        part = staged.filter(value.isin([v for v in values if v is not None]) | (value.isNull() if None in values else F.lit(False)))
        write_parquet(part, path, partition_by=[partition_by], sort_by=sort_by, replace="all" if foreign else "partitions")
    for folder in gone:
        _delete(spark, f"{path}/{folder}")
    if changed or gone or foreign or not known:
        rows = [(f, *told[1:], _file_names(spark, f"{path}/{f}")) for f, told in sorted(wanted.items())]
        spark.createDataFrame(rows, _CHECKSUM_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{CHECKSUMS}")
    return Changes(changed, sorted(same), gone, sum(told[1] for told in wanted.values()))


def partition_folder(column: str, value: str | None) -> str:
    """Folder name of a partition value, as Spark writes it."""
    return f"{column}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else quote(value, safe=" !$&()+,-.;<>@_`|~"))


def _file_names(spark: SparkSession, folder: str) -> list[str]:
    return sorted(c for c in child_names(spark, folder) or [] if not c.startswith(("_", ".")))


def _checksums(spark: SparkSession, path: str) -> dict[str, tuple]:
    if f"{CHECKSUMS}" not in (child_names(spark, path) or []) or "_SUCCESS" not in (child_names(spark, f"{path}/{CHECKSUMS}") or []):
        return {}
    return {r[0]: (*r[1:5], list(r[5])) for r in spark.read.schema(_CHECKSUM_SCHEMA).parquet(f"{path}/{CHECKSUMS}").collect()}


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_snapshot(df: DataFrame, path: str, ingestion_date: str) -> None:
    """Replace one dated snapshot, be it empty, and leave the other dates.

    All rows go to one folder, so they are written by the tasks that read them.
    """
    df.write.mode("overwrite").parquet(f"{path}/{INGESTION_DATE}={ingestion_date}")


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str], order_by: Sequence[str] = ()
) -> None:
    """Export chosen columns, in order, with a header; files follow the sort order."""
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, ingestion_date: str) -> None:
    """Append events below their ingestion date."""
    dated = df.withColumn(INGESTION_DATE, F.lit(ingestion_date))
    dated.write.mode("append").partitionBy(INGESTION_DATE).json(path)
