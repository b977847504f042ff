"""Running sums of streamed measurements, added to batch sums at one grain.

Layout below a folder: ``batches/batch_id=N`` holds the running totals of the keys
that micro-batch N touched; ``snapshots/upto=N`` holds the totals of all keys after N.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardline.names import DOMAIN, Names
from yardline.operators.integrate import SCORE_SUM, SCORE_WEIGHT, add_sums, grain_sums
from yardline.streaming.events import EVERY_TEN_SECONDS

BATCH = "batch_id"


def keep_totals(
    measures: DataFrame,
    path: str,
    checkpoint: str,
    names: Names = DOMAIN,
    trigger: Mapping = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Keep sums per year x entity x segment; state is one row per key.

    Each micro-batch overwrites its own folder, so a repeated batch changes nothing.
    An empty batch writes nothing. The state is computed once, into executor storage, and
    written by the tasks that hold it; the snapshot makes few files of many.
    """

    def save(totals: DataFrame, batch_id: int) -> None:
        totals = totals.persist()
        try:
            if not totals.isEmpty():
                totals.write.mode("overwrite").parquet(f"{path}/batches/{BATCH}={batch_id}")
        finally:
            totals.unpersist()

    return (
        grain_sums(measures, names)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _finished(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the sub-folders whose write was finished, found by one listing."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*/_SUCCESS")
    fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(done) or []
    return sorted(int(status.getPath().getParent().getName()[len(prefix) :]) for status in found)


def _batches(spark: SparkSession, path: str, after: int, names: Names) -> DataFrame:
    """Rows of the finished batches after a number; earlier folders are not opened."""
    later = [n for n in _finished(spark, f"{path}/batches", f"{BATCH}=") if n > after]
    if not later:
        return spark.createDataFrame([], _schema(names))
    reader = spark.read.schema(_schema(names)).option("basePath", f"{path}/batches")
    return reader.parquet(*[f"{path}/batches/{BATCH}={n}" for n in later])


def read_totals(spark: SparkSession, path: str, names: Names = DOMAIN) -> DataFrame:
    """The latest total of every key: newest finished snapshot and the finished batches after it."""
    upto = max(_finished(spark, f"{path}/snapshots", "upto="), default=-1)
    batches = _batches(spark, path, upto, names)
    if upto >= 0:
        snapshot = spark.read.schema(_schema(names)).parquet(f"{path}/snapshots/upto={upto}")
        batches = batches.unionByName(snapshot.withColumn(BATCH, F.lit(upto).cast("bigint")))
    sums = [names.assessed, names.reached, SCORE_SUM, SCORE_WEIGHT]
    newest = [F.max_by(c, BATCH).alias(c) for c in sums]
    return batches.groupBy(*names.grain).agg(*newest)


def snapshot_totals(spark: SparkSession, path: str, names: Names = DOMAIN) -> int | None:
    """Fold the finished batches into a snapshot, so that readers open few folders.

    A snapshot that is there already is left as it is. Batches go once a snapshot before this
    one holds them, so a reader that has just chosen the last snapshot still finds its batches.
    """
    done = _finished(spark, f"{path}/batches", f"{BATCH}=")
    kept = _finished(spark, f"{path}/snapshots", "upto=")
    upto = max([*done, *kept], default=None)
    if upto is None or upto in kept:
        return upto
    read_totals(spark, path, names).write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
    for n in done:
        if kept and n <= kept[-1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batches/{BATCH}={n}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return upto


def add_stream(batch_sums: DataFrame, stream_totals: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Batch and stream sums per key; ``finish`` turns them into indicators."""
    return add_sums(batch_sums.unionByName(stream_totals), names)


def _schema(n: Names) -> str:
    return (
        f"{n.year} int, {n.entity} bigint, {n.segment} string, {n.assessed} bigint, "
        f"{n.reached} bigint, {SCORE_SUM} double, {SCORE_WEIGHT} bigint, {BATCH} bigint"
    )
