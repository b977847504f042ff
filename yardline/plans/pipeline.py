"""The layered run: bronze, silver, silver gate, gold, gold gate."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Literal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from yardline.names import DOMAIN as N
from yardline.operators import marts
from yardline.operators.checks import CHECK_SCHEMA, Rule, check_all
from yardline.operators.clean import is_rejected, newest_per_key, typed
from yardline.operators.integrate import enrich, finish, first_per_event, grain_sums
from yardline.plans.event_sums import event_sums, has_dates, stream_folders
from yardline.plans.metrics import RunMetrics, observed
from yardline.plans.schemas import layer_schema, read_layer
from yardline.plans.suite import gold_suite, outcome, raise_on_failure, silver_suite
from yardline.sources.lake import Lake, child_names, write_changed, write_parquet, write_snapshot
from yardline.sources.readers import CORRUPT, read_event_lines, read_source
from yardline.streaming.totals import add_stream
from yardline.tables import (
    BATCH_TABLES,
    EVENT_TABLE,
    INGESTED_AT,
    INGESTION_DATE,
    SOURCE_TABLE,
    TableSpec,
    batch_table,
)

STAGES = ("bronze", "silver", "gold")
ALL_STAGES = (*STAGES, "quality")
QUARANTINE = "quarentena"


@dataclass
class Run:
    """Settings of one run. Every stage only reads files of the stage before it."""

    spark: SparkSession
    lake: Lake
    ingestion_date: str
    seeds: str = ""
    use_warehouse: bool = False
    warehouse_format: str | None = None
    warehouse_options: Mapping[str, str] = field(default_factory=dict)
    deduplicate_events: bool = False
    null_scores: Literal["count", "exclude"] = "count"
    tables_at_once: int = 4
    metrics: RunMetrics = field(default_factory=RunMetrics)


def together(run: Run, tasks: Iterable[Callable[[], object]]) -> None:
    """Submit writes that do not depend on each other at the same time, so that small
    tables fill executors a large one leaves idle."""
    with ThreadPoolExecutor(max_workers=run.tables_at_once) as pool:
        in_session = inheritable_thread_target(run.spark)
        futures = [pool.submit(in_session(task)) for task in tasks]
    for future in futures:
        future.result()


def with_ingestion_metadata(df: DataFrame, table: str) -> DataFrame:
    """Time and name of the ingest; its date is the folder the rows are written to."""
    return df.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_TABLE: F.lit(table)})


def ingest_table(run: Run, spec: TableSpec) -> str:
    """Land one source under its ingestion date; other dates stay as they are.

    Row counts are observed on the write. Lines that did not fit the declared
    columns are counted and kept whole in the date's quarantine, which a re-run replaces,
    be it by an empty one.
    """
    source = read_source(
        run.spark,
        spec,
        run.seeds,
        run.warehouse_format,
        run.warehouse_options,
        run.use_warehouse,
    )
    if CORRUPT not in source.columns:
        source = source.withColumn(CORRUPT, F.lit(None).cast("string"))
    malformed = F.count_if(F.col(CORRUPT).isNotNull())
    counted, counts = observed(source, f"ingest {spec.name}", malformed=malformed)
    path = run.lake.path("bronze", spec.name)
    landed = with_ingestion_metadata(counted.drop(CORRUPT), spec.name)
    write_snapshot(landed, path, run.ingestion_date)
    found = counts.get
    run.metrics.add("bronze", "RecordsIngested", found["rows"], table=spec.name)
    run.metrics.add("bronze", "RecordsMalformed", found["malformed"], table=spec.name)
    _quarantine(run, source if found["malformed"] else source.limit(0), spec.name)
    return path


def _quarantine(run: Run, rows: DataFrame, table: str) -> None:
    """Keep the malformed lines whole, beside whatever could be parsed of them."""
    bad = rows.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "line")
    path = run.lake.path("bronze", f"{QUARANTINE}/{table}")
    write_snapshot(with_ingestion_metadata(bad, table), path, run.ingestion_date)


def _quarantine_events(run: Run, landed: DataFrame) -> None:
    """Keep malformed event lines below the date they landed on: of the run's date, which is
    replaced, and of earlier dates that no run has looked through yet."""
    path = run.lake.path("bronze", f"{QUARANTINE}/{EVENT_TABLE}")
    prefix = f"{INGESTION_DATE}="
    if INGESTION_DATE not in landed.columns:
        return _quarantine(run, landed, EVENT_TABLE)
    done = [c[len(prefix) :] for c in child_names(run.spark, path) or [] if c.startswith(prefix)]
    earlier = [d for d in done if d != run.ingestion_date]
    date = F.col(INGESTION_DATE)
    fresh = landed.filter(~date.isin([datetime.date.fromisoformat(d) for d in earlier])) if earlier else landed
    bad = fresh.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "line")
    # The run's date first, empty if need be: its folder tells that the date was looked through.
    own = bad.filter(date == F.lit(run.ingestion_date).cast("date")).drop(INGESTION_DATE)
    write_snapshot(with_ingestion_metadata(own, EVENT_TABLE), path, run.ingestion_date)
    late = with_ingestion_metadata(bad.filter(date < F.lit(run.ingestion_date).cast("date")), EVENT_TABLE)
    late.write.mode("append").partitionBy(INGESTION_DATE).parquet(path)


def ingest(run: Run, tables: Iterable[str] | None = None) -> None:
    specs = [batch_table(name) for name in tables] if tables else list(BATCH_TABLES.values())
    together(run, [partial(ingest_table, run, spec) for spec in specs])


def _write(run: Run, layer: str, table: str, df: DataFrame, sort_by: list[str]) -> None:
    """Years that did not change keep their files; tables without years are written whole."""
    path = run.lake.path(layer, table)
    if N.year in df.columns:
        changes = write_changed(df, path, N.year, [c for c in sort_by if c != N.year])
        run.metrics.add(layer, "RecordsWritten", changes.rows, table=table)
        run.metrics.add(layer, "PartitionsRewritten", len(changes.written), table=table)
        run.metrics.add(layer, "PartitionsKept", len(changes.kept), table=table)
        return
    counts = Observation(f"{layer} {table}")
    write_parquet(df, path, sort_by=sort_by, count_into=counts)
    run.metrics.add(layer, "RecordsWritten", counts.get["rows"], table=table)


def _bronze(run: Run, spec: TableSpec) -> DataFrame:
    """The snapshot of the run's date or, where there is none, the newest before it."""
    schema = layer_schema(run.spark, "bronze", spec.name)
    return run.lake.read_newest(run.spark, "bronze", spec.name, run.ingestion_date, schema)


def _write_clean(run: Run, spec: TableSpec) -> None:
    raw = _bronze(run, spec)
    rows, counts = observed(
        typed(raw, spec, keep=[INGESTED_AT]),
        f"clean {spec.name}",
        rejected=F.count_if(is_rejected(spec)),
    )
    kept = rows.filter(~is_rejected(spec))
    newest_by = [c for c in (INGESTED_AT,) if c in kept.columns]
    _write(
        run,
        "silver",
        spec.name,
        newest_per_key(kept, spec.key, newest_by, drop=newest_by),
        list(spec.key),
    )
    run.metrics.add("silver", "RecordsRead", counts.get["rows"], table=spec.name)
    run.metrics.add("silver", "RecordsRejected", counts.get["rejected"], table=spec.name)


def silver(run: Run) -> None:
    """Events are summed while the tables are cleaned, and malformed ones set apart while measures are written."""
    spec, events = batch_table("alunos"), []
    cleaned = [partial(_write_clean, run, s) for s in BATCH_TABLES.values() if s.key]
    together(run, [lambda: events.append(_event_part(run, spec)), *cleaned])
    entities = read_layer(run.spark, run.lake, "silver", "municipio")
    groups = read_layer(run.spark, run.lake, "silver", "uf")
    batch = typed(_bronze(run, spec), spec)

    streamed, lines, seen = events[0]
    sums = add_stream(grain_sums(batch), streamed)
    measures = enrich(finish(sums, null_scores=run.null_scores), marts.dimension(entities, groups))
    writes = [partial(_write, run, "silver", "alunos", measures, [N.entity, N.segment])]
    together(run, [*writes, *([partial(_quarantine_events, run, lines)] if lines is not None else [])])
    found = seen()
    run.metrics.add("silver", "RecordsRead", found["rows"], table=EVENT_TABLE)
    run.metrics.add("silver", "RecordsMalformed", found["malformed"], table=EVENT_TABLE)


def _event_part(run: Run, spec: TableSpec) -> tuple[DataFrame, DataFrame | None, Callable[[], dict]]:
    """Sums of the events up to the run's date, the lines opened for them, and their counts.

    Sums are carried from run to run, so only folders that are new are opened. Redelivered events
    can only be told among all events, and undated files only be read whole.
    """
    if not run.deduplicate_events and has_dates(run.spark, run.lake):
        kept = event_sums(run.spark, run.lake, run.ingestion_date)
        return kept.sums, kept.lines, lambda: {"rows": kept.rows, "malformed": kept.malformed}
    landed = read_event_lines(
        run.spark, run.lake.path("bronze", EVENT_TABLE), stream_folders(run.lake)
    )
    if INGESTION_DATE in landed.columns:  # a run for an earlier date does not know later events
        landed = landed.filter(F.col(INGESTION_DATE) <= F.lit(run.ingestion_date).cast("date"))
    lines, counts = observed(
        landed, "events", malformed=F.count_if(F.col(CORRUPT).isNotNull())
    )
    events = lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    if run.deduplicate_events:
        events = first_per_event(events)
    return grain_sums(typed(events, spec)), landed, lambda: counts.get


def _gate(run: Run, suite: list[tuple[str, list[Rule]]], tables: dict[str, str]) -> None:
    """Check written tables, keep every result, then stop the run if a critical rule failed."""
    frames = {name: read_layer(run.spark, run.lake, layer, name) for name, layer in tables.items()}
    rows = outcome(check_all(suite, frames))
    kept = run.spark.createDataFrame(rows, CHECK_SCHEMA)
    kept = kept.withColumns(
        {INGESTION_DATE: F.lit(run.ingestion_date), "checked_at": F.current_timestamp()}
    )
    kept.write.mode("append").parquet(f"{run.lake.root.rstrip('/')}/quality_results")
    raise_on_failure(rows)


SILVER_CHECKED = dict.fromkeys(("uf", "municipio", "meta_municipio", "alunos"), "silver")
GOLD_CHECKED = {"indicador_municipio": "gold"}


def silver_gate(run: Run) -> None:
    _gate(run, silver_suite(), SILVER_CHECKED)


def gold_gate(run: Run) -> None:
    _gate(run, gold_suite(), GOLD_CHECKED)


def quality(run: Run) -> None:
    """The whole suite over tables that are already written."""
    _gate(run, [*silver_suite(), *gold_suite()], {**SILVER_CHECKED, **GOLD_CHECKED})


def gold(run: Run) -> None:
    """The indicator mart is written first; the marts that sum or compare it over time
    read it back instead of aggregating the fact grain again."""

    def table(layer: str, name: str) -> DataFrame:
        return read_layer(run.spark, run.lake, layer, name)

    measures = table("silver", "alunos")
    entity_targets = table("silver", "meta_municipio")
    dimension = marts.dimension(table("silver", "municipio"), table("silver", "uf"))
    fact = marts.fact(measures, entity_targets)
    indicator = marts.indicator(marts.consolidated(measures), entity_targets)
    together(
        run,
        [
            partial(_write, run, "gold", "indicador_municipio", indicator, [N.entity]),
            partial(_write, run, "gold", "fato_alfabetizacao", fact, [N.entity, N.segment]),
            partial(_write, run, "gold", "dim_municipio", dimension, [N.entity]),
        ],
    )
    total = table("gold", "indicador_municipio")
    evolution = marts.evolution(total)
    comparison = marts.group_comparison(total, table("silver", "meta_uf"))
    together(
        run,
        [
            partial(_write, run, "gold", "evolucao_temporal", evolution, [N.entity]),
            partial(_write, run, "gold", "comparacao_meta_uf", comparison, [N.group_code]),
        ],
    )


def run_stages(
    run: Run, stages: Iterable[str] = STAGES, tables: Iterable[str] | None = None
) -> RunMetrics:
    """Run the stages in order in one session; a failing stage ends the run.

    Silver and gold each end with their gate; ``quality`` checks both once more.
    """
    unknown = set(stages) - set(ALL_STAGES)
    if unknown:
        raise KeyError(f"unknown stage(s) {sorted(unknown)}; known: {ALL_STAGES}")
    try:
        if "bronze" in stages:
            with run.metrics.stage("bronze"):
                ingest(run, tables)
        if "silver" in stages:
            with run.metrics.stage("silver"):
                silver(run)
            with run.metrics.stage("silver_gate"):
                silver_gate(run)
        if "gold" in stages:
            with run.metrics.stage("gold"):
                gold(run)
            with run.metrics.stage("gold_gate"):
                gold_gate(run)
        if "quality" in stages:
            with run.metrics.stage("quality"):
                quality(run)
    finally:
        run.metrics.save(run.spark, f"{run.lake.root.rstrip('/')}/run_metrics")
    return run.metrics
