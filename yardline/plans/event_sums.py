"""Sums of all landed events, carried from run to run: a run opens only folders it has not summed yet.

Layout below ``state/event_sums``: ``upto=<date>/sums`` holds one row per year x entity x segment over
all valid events that landed up to the date; ``upto=<date>/covered`` tells which folders these were, with
number, bytes and time of their files. A state counts once ``covered`` is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardline.names import DOMAIN, Names
from yardline.operators.clean import typed
from yardline.operators.integrate import SCORE_SUM, SCORE_WEIGHT, add_sums, grain_sums
from yardline.plans.metrics import observed, observed_or_counted
from yardline.sources.lake import Lake, child_names
from yardline.sources.readers import CORRUPT, read_event_lines
from yardline.tables import EVENT_BATCHES, EVENT_LANDING, EVENT_TABLE, INGESTION_DATE, measure_spec

_PREFIX, _UPTO = f"{INGESTION_DATE}=", "upto="
#: Folders that only landing streams write.
STREAMED = (EVENT_LANDING, EVENT_BATCHES)
_COVERED = "source string, date string, files bigint, bytes bigint, changed bigint"


def sums_schema(n: Names = DOMAIN) -> str:
    return (
        f"{n.year} int, {n.entity} bigint, {n.segment} string, {n.assessed} bigint, {n.reached} bigint, "
        f"{SCORE_SUM} double, {SCORE_WEIGHT} bigint"
    )


def stream_folders(lake: Lake) -> list[str]:
    return [lake.path("bronze", table) for table in STREAMED]


@dataclass(frozen=True)
class EventSums:
    """Sums up to a date, the lines of folders that were opened for them, and what these lines held."""

    sums: DataFrame
    opened: list[str]
    lines: DataFrame | None
    rows: int = 0
    malformed: int = 0


def _folders(spark: SparkSession, lake: Lake, upto: str) -> dict[tuple[str, str], tuple[int, int, int]]:
    """Dated event folders up to a date with number, bytes and newest change of their files."""
    found = {}
    for source in (EVENT_TABLE, *STREAMED):
        path = lake.path("bronze", source)
        for child in child_names(spark, path) or []:
            date = child[len(_PREFIX) :]
            if not child.startswith(_PREFIX) or date > upto:
                continue
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{child}")
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            size = fs.getContentSummary(folder)
            changed = fs.getFileStatus(folder).getModificationTime()
            found[source, date] = (size.getFileCount(), size.getLength(), changed)
    return found


def has_dates(spark: SparkSession, lake: Lake) -> bool:
    """Whether events lie in dated folders, or there are none; files beside them cannot be told apart by date."""
    children = [c for c in child_names(spark, lake.path("bronze", EVENT_TABLE)) or [] if not c.startswith(("_", "."))]
    return all(c.startswith(_PREFIX) for c in children)


def _usable(spark: SparkSession, root: str, before: str, now: dict) -> tuple[str, set] | None:
    """The newest state before a date whose folders are all as they were, and none beside them."""
    states = sorted((c[len(_UPTO) :] for c in child_names(spark, root) or [] if c.startswith(_UPTO)), reverse=True)
    for date in states:
        place = f"{root}/{_UPTO}{date}"
        if date >= before or "_SUCCESS" not in (child_names(spark, f"{place}/covered") or []):
            continue
        covered = {(r[0], r[1]): tuple(r[2:]) for r in spark.read.schema(_COVERED).parquet(f"{place}/covered").collect()}
        if covered == {k: v for k, v in now.items() if k[1] <= date}:
            return place, set(covered)
    return None


def event_sums(spark: SparkSession, lake: Lake, date: str, names: Names = DOMAIN) -> EventSums:
    """Sums of all valid events landed up to ``date``: the newest usable state and the folders after it.

    A file that comes late into a folder already summed makes the states that hold it unusable, so the sums are
    always those of all files. The new state replaces one of the same date; earlier dates never read it.
    """
    root = f"{lake.root.rstrip('/')}/state/event_sums"
    now = _folders(spark, lake, date)
    base = _usable(spark, root, date, now)
    opened = sorted({d for _, d in set(now) - (base[1] if base else set())})
    parts, found, lines = [], {"rows": 0, "malformed": 0}, None
    if base is not None:
        parts.append(spark.read.schema(sums_schema(names)).parquet(f"{base[0]}/sums"))
    counts = None
    if opened:
        lines = read_event_lines(
            spark, lake.path("bronze", EVENT_TABLE), stream_folders(lake), names, dates=opened
        )
        malformed = F.count_if(F.col(CORRUPT).isNotNull())
        watched, counts = observed(lines, "events", malformed=malformed)
        events = watched.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        parts.append(grain_sums(typed(events, measure_spec(names)), names))
    if not parts:
        parts.append(spark.createDataFrame([], sums_schema(names)))
    total = add_sums(parts[0].unionByName(parts[1]), names) if len(parts) > 1 else parts[0]
    place = f"{root}/{_UPTO}{date}"
    total.write.mode("overwrite").parquet(f"{place}/sums")
    if counts is not None:
        found = observed_or_counted(counts, lines, malformed=malformed)
    covered = [(*key, *told) for key, told in sorted(now.items())]
    spark.createDataFrame(covered, _COVERED).coalesce(1).write.mode("overwrite").parquet(f"{place}/covered")
    sums = spark.read.schema(sums_schema(names)).parquet(f"{place}/sums")
    return EventSums(sums, opened, lines, found["rows"], found["malformed"])
