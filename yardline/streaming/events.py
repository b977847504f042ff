"""Event lines as streams: reading, decoding, parsing, landing, quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardline.functions import decode_payload
from yardline.names import DOMAIN, Names
from yardline.operators.clean import typed
from yardline.operators.events import CORRUPT, filled_lines, malformed_lines, parsed
from yardline.tables import INGESTION_DATE, measure_spec

# A micro-batch every ten seconds.
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
ALL_AVAILABLE = {"availableNow": True}


def read_lines(
    spark: SparkSession, path: str, max_files: int | None = None, **options: str
) -> DataFrame:
    """Text files appearing in a folder, as a stream of lines (column ``value``)."""
    reader = spark.readStream.options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value")


def decoded_lines(records: DataFrame, payload: str = "data") -> DataFrame:
    """Base64 record payloads as lines; what cannot be decoded stays as it came."""
    return records.select(decode_payload(F.col(payload).cast("string")).alias("value"))


def measurements(events: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Typed measurements, with the rows breaking reached <= assessed counted in the
    query progress under ``event_invariant``."""
    rows = typed(events, measure_spec(names))
    return rows.observe(
        "event_invariant",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(names.reached) > F.col(names.assessed)).alias("reached_above_assessed"),
    )


def land(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    ingestion_date: str | None = None,
    trigger: Mapping = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Append raw lines below their ingestion date, each line once.

    The file sink's log together with the checkpoint makes a repeated micro-batch
    write nothing twice. Without ``ingestion_date`` the date is that of the
    micro-batch, which a replay keeps. Malformed lines land too and are set apart on
    the way to Silver; a batch of blank lines lands nothing.
    """
    date = F.current_date() if ingestion_date is None else F.lit(ingestion_date).cast("date")
    return (
        filled_lines(lines)
        .select("value")
        .withColumn(INGESTION_DATE, date)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(INGESTION_DATE)
        .trigger(**trigger)
        .start()
    )


def quarantine(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    names: Names = DOMAIN,
    trigger: Mapping = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Append the lines that are no JSON event to a quarantine folder."""
    return (
        malformed_lines(lines, names)
        .select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def land_apart(
    lines: DataFrame,
    landed: str,
    apart: str,
    checkpoint: str,
    ingestion_date: str | None = None,
    names: Names = DOMAIN,
    trigger: Mapping = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Append events below ``landed`` and lines that are none below ``apart``, in one step.

    A line is read and parsed once, and lands in exactly one of the two. Each micro-batch replaces the
    folders of its own number in both, so one that is repeated after a failure between the two
    writes changes nothing that is there already. Dates are as with ``land``.
    """
    date = F.current_date() if ingestion_date is None else F.lit(ingestion_date).cast("date")
    judged = filled_lines(lines).select(
        "value", date.alias(INGESTION_DATE), parsed(F.col("value"), names)[CORRUPT].isNotNull().alias("malformed")
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            for path, wanted in ((landed, ~F.col("malformed")), (apart, F.col("malformed"))):
                write_batch(batch.filter(wanted).drop("malformed"), path)
        finally:
            batch.unpersist()

    return judged.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_batch(rows: DataFrame, path: str) -> None:
    """Replace a micro-batch's own folders, one below each date."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(INGESTION_DATE, "batch_id").text(path)


def drop_redelivered(
    events: DataFrame,
    delay: str,
    event_id: str = "event_id",
    event_time: str = "event_time",
    salts: int = 16,
) -> DataFrame:
    """Optional streaming dedup: one delivery of an id within ``delay``.

    State is bounded by the watermark; an event with an id that comes later than that is
    dropped and counted in the query's progress (``numRowsDroppedByWatermark``). Events without
    an id are never taken for copies: they go past the state, so none is late or kept in it.
    An id redelivered very many times is first reduced per salt, over many tasks, and only those
    survivors meet in one.
    """
    without_id = events.filter(F.col(event_id).isNull())
    timed = (
        events.filter(F.col(event_id).isNotNull())
        .withColumns({"_time": F.try_to_timestamp(event_time), "_salt": F.spark_partition_id() % salts})
        .withWatermark("_time", delay)
    )
    spread = timed.dropDuplicatesWithinWatermark([event_id, "_salt"]) if salts > 1 else timed
    kept = spread.dropDuplicatesWithinWatermark([event_id])
    return kept.drop("_time", "_salt").unionByName(without_id)
