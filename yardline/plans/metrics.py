"""Run metrics: counts observed on the writes themselves, stage outcome and duration."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

SCHEMA = (
    "stage string, metric string, value double, unit string, "
    "dimensions map<string,string>, at timestamp"
)


@dataclass
class RunMetrics:
    rows: list[tuple] = field(default_factory=list)

    def add(self, stage: str, metric: str, value: float, unit: str = "Count", **dims: str) -> None:
        now = dt.datetime.now(dt.UTC)
        self.rows.append((stage, metric, float(value), unit, dims, now))

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        """Record duration and outcome; a failure is recorded and passed on."""
        # Published metric names.
        start = time.monotonic()
        outcome = "StageFailure"
        try:
            yield
            outcome = "StageSuccess"
        finally:
            seconds = round(time.monotonic() - start, 2)
            self.add(name, "StageDurationSeconds", seconds, "Seconds")
            self.add(name, outcome, 1)

    def value(self, metric: str, **dims: str) -> float | None:
        found = [r[2] for r in self.rows if r[1] == metric and dims.items() <= r[4].items()]
        return found[-1] if found else None

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).write.mode("append").parquet(path)


def observed(df: DataFrame, name: str, **columns: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and more) on the way to a write, without a second job.

    Counts taken before a shuffle may include rows of map tasks that ran twice; they are
    for watching, and only ask whether there is anything to set apart.
    """
    observation = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [column.alias(key) for key, column in columns.items()]
    return df.observe(observation, *counts), observation


def observed_or_counted(observation: Observation, df: DataFrame, **columns: Column) -> dict:
    """What was observed on the way to a write; counted by a job of its own where nothing was.

    Spark drops a part of the plan that turns out to be empty while it runs, and what was observed in it.
    """
    try:
        return observation.get
    except Py4JError:
        counts = [column.alias(key) for key, column in columns.items()]
        return df.agg(F.count(F.lit(1)).alias("rows"), *counts).first().asDict()


class StreamMetrics(StreamingQueryListener):
    """Progress, observed counts, lateness and outcome of streams, appended to the run metrics.

        with StreamMetrics(spark, f"{root}/run_metrics", "landing"):
            land(...).awaitTermination()

    Rows are kept for some micro-batches and written together, at the latest when a stream ends or the block is left;
    a stream that fails is recorded as such. One listener may watch several streams of a session.
    """

    def __init__(self, spark: SparkSession, path: str, stage: str, rows_at_once: int = 500):
        self._spark, self._path, self._stage, self._most = spark, path, stage, rows_at_once
        self._kept, self._lock = RunMetrics(), threading.Lock()

    def __enter__(self) -> StreamMetrics:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure: object) -> None:
        # Events of streams that have just ended are still on their way.
        self._spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self._spark.streams.removeListener(self)
        self.save()

    def save(self) -> None:
        with self._lock:
            rows, self._kept.rows = self._kept.rows, []
        if rows:
            RunMetrics(rows).save(self._spark, self._path)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event: QueryIdleEvent) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:  # noqa: N802
        told = event.progress
        stream = {"stream": str(told.name or told.id), "batch": str(told.batchId)}
        found = [("InputRows", told.numInputRows, "Count")]
        found.append(("BatchDurationMilliseconds", told.durationMs.get("triggerExecution", 0), "Milliseconds"))
        found += [
            ("RowsDroppedByWatermark", state.numRowsDroppedByWatermark, "Count") for state in told.stateOperators
        ]
        found += [("StateRows", state.numRowsTotal, "Count") for state in told.stateOperators]
        late = _lateness(dict(told.eventTime or {}))
        if late is not None:
            found.append(("WatermarkLagSeconds", late, "Seconds"))
        for name, row in (told.observedMetrics or {}).items():
            found += [(f"{name}.{key}", value, "Count") for key, value in row.asDict().items() if value is not None]
        self._add(found, stream)

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:  # noqa: N802
        outcome = "StageSuccess" if event.exception is None else "StageFailure"
        self._add([(outcome, 1, "Count")], {"stream": str(event.id)})
        self.save()

    def _add(self, found: list[tuple[str, float, str]], dimensions: dict[str, str]) -> None:
        with self._lock:
            for metric, value, unit in found:
                self._kept.add(self._stage, metric, value, unit, **dimensions)
            full = len(self._kept.rows) >= self._most
        if full:
            self.save()


def _lateness(times: dict[str, str]) -> float | None:
    """Seconds between the newest event of a micro-batch and the watermark."""
    if "max" not in times or "watermark" not in times:
        return None
    newest, mark = (dt.datetime.fromisoformat(times[k].replace("Z", "+00:00")) for k in ("max", "watermark"))
    return (newest - mark).total_seconds()


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Input rows, rates and observed counts of a stream's recent micro-batches."""
    found = []
    for progress in query.recentProgress:
        observed_rows = {
            key: row.asDict() for key, row in (progress.observedMetrics or {}).items()
        }
        found.append(
            {
                "batch_id": progress.batchId,
                "input_rows": progress.numInputRows,
                "rows_per_second": progress.processedRowsPerSecond,
                "observed": observed_rows,
            }
        )
    return found
