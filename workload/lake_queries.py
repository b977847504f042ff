"""Queries that go through files: sources, sinks, streams and the layered run.

Scratch folders lie below the checkpoint folder the session names.
"""

from __future__ import annotations

import dataclasses
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workload import tables as t
from workload.queries import EVENTS_SQL, NETWORK_SQL, WIDE_SQL, YEARS, query, wide_sheet
from workload.tables import E, sql
from yardline.names import DOMAIN
from yardline.operators import reshape
from yardline.operators.clean import typed
from yardline.operators.integrate import enrich, finish, grain_sums
from yardline.operators.microdata import weighted_microdata
from yardline.operators.checks import check_all
from yardline.operators.events import valid_events
from yardline.plans import catalog, source_prep
from yardline.plans.metrics import RunMetrics, StreamMetrics
from yardline.plans.pipeline import (
    QUARANTINE,
    Run,
    run_stages,
    together,
    with_ingestion_metadata,
)
from yardline.plans.suite import QualityGateError, gate, silver_suite
from yardline.session import materialise, scratch_dir
from yardline.sources import arrow_export, readers
from yardline.sources.lake import (
    Lake,
    write_changed,
    write_csv,
    write_json_lines,
    write_parquet,
    write_snapshot,
)
from yardline.streaming import events as ev
from yardline.streaming import totals
from yardline.tables import BATCH_TABLES, EVENT_TABLE, INGESTED_AT, INGESTION_DATE, entity_spec, measure_spec

# --- scans and sinks ------------------------------------------------------------------


@query(
    """select o_orderkey, o_custkey, date '2026-01-05' as ingestion_date,
              'orders' as source_table from orders"""
)
def bronze_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as a dated snapshot and read back with the technical columns."""
    lake = Lake(scratch_dir(spark, "bronze"))
    orders = t.load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    landed = with_ingestion_metadata(orders, "orders")
    write_snapshot(landed, lake.path("bronze", "orders"), "2026-01-05")
    return lake.read_newest(spark, "bronze", "orders").drop(INGESTED_AT)


@query(
    """select date '2026-01-01' as ingestion_date, false as newest, count(*) as n,
              cast(sum(o_custkey) as bigint) as keys from orders
       union all
       select date '2026-01-02', true, count(*), cast(sum(o_custkey + 1) as bigint) from orders"""
)
def partition_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two dated snapshots, the second written twice; both stay and the newest is read."""
    lake = Lake(scratch_dir(spark, "partitions"))
    path = lake.path("bronze", "orders")
    orders = t.load(spark, folder, "orders")
    for date, shift in (("2026-01-01", 0), ("2026-01-02", 9), ("2026-01-02", 1)):
        rows = orders.withColumn("o_custkey", F.col("o_custkey") + shift)
        write_snapshot(with_ingestion_metadata(rows, "orders"), path, date)
    counts = [F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys")]
    newest = lake.read_newest(spark, "bronze", "orders").select(INGESTION_DATE).distinct()
    every = lake.read(spark, "bronze", "orders").groupBy(INGESTION_DATE).agg(*counts)
    marked = every.join(newest.withColumn("newest", F.lit(True)), INGESTION_DATE, "left")
    return marked.select(
        F.col(INGESTION_DATE).cast("date").alias(INGESTION_DATE),
        F.coalesce("newest", F.lit(False)).alias("newest"),
        "n",
        "keys",
    )


@query(
    """select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as year
       from orders where year(o_orderdate) = 1997 and o_totalprice > 100000"""
)
def layer_scan_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A year-partitioned layer table, registered in the catalog and queried in SQL."""
    lake = Lake(scratch_dir(spark, "layer"))
    orders = t.load(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    path = lake.path("gold", "orders")
    write_parquet(orders, path, partition_by=["year"], sort_by=["o_totalprice"])
    database = f"gold_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, lake, "gold", database, ("orders",))
    return spark.sql(
        f"""select o_orderkey, o_totalprice, year from {database}.orders
            where year = 1997 and o_totalprice > 100000"""
    )


@query(sql("select * from entities", "entities"))
def seed_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted CSV export and the header-checked scan of it."""
    spec, seeds = entity_spec(E), scratch_dir(spark, "seeds")
    columns = [f.name for f in spec.fields]
    path = f"{seeds}/{spec.seed_file}"
    write_csv(t.entities(spark, folder), path, columns, [E.entity])
    return typed(readers.read_source(spark, spec, seeds), spec)


@query(sql("select * from entities", "entities"))
def warehouse_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same source as a catalog table with more columns than declared."""
    lake = Lake(scratch_dir(spark, "warehouse"))
    entities = t.entities(spark, folder).withColumn("extra", F.lit(1))
    write_parquet(entities, lake.path("bronze", "municipio"))
    database = f"warehouse_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, lake, "bronze", database, ("municipio",))
    spec = dataclasses.replace(entity_spec(E), warehouse_table=f"{database}.municipio")
    return readers.read_source(spark, spec, "", use_warehouse=True)


@query(sql("select * from entities where group_id = 7 and entity_id >= 10", "entities"))
def warehouse_connector_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same source exported by executors as Arrow files of more columns, read by the connector.

    Only the declared columns are read, and the conditions are applied in the reading tasks.
    """
    path = scratch_dir(spark, "export")
    entities = t.entities(spark, folder).withColumn("extra", F.lit("x" * 20))
    arrow_export.register(spark)
    writer = entities.repartition(3).write.format(arrow_export.NAME).mode("append")
    writer.option("path", path).option("table", "directory.entities").save()
    spec = dataclasses.replace(entity_spec(E), warehouse_table="directory.entities")
    rows = readers.read_source(spark, spec, "", arrow_export.NAME, {"path": path, "split_bytes": "4096"})
    return rows.filter(f"{E.group} = 7 and {E.entity} >= 10")


# --- source preparation ---------------------------------------------------------------


def _states_json(spark: SparkSession, folder: str) -> str:
    path = scratch_dir(spark, "states")
    region = F.struct(F.col(E.region_id).alias("id"), F.col(E.region).alias("nome"))
    t.groups(spark, folder).select(
        (F.col(E.group) + 10).alias("id"),
        F.col(E.group_code).alias("sigla"),
        F.col(E.group_label).alias("nome"),
        region.alias("regiao"),
    ).write.json(path)
    return path


@query(
    sql(
        """select cast(group_id + 10 as integer) as group_id, group_code, group_name, region_id,
                  region_name from groups""",
        "groups",
    )
)
def states_json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_states(spark, _states_json(spark, folder), E, multi_line=False)


@query(
    sql(
        """select c_custkey + (10 + c_nationkey) * 1000000000000 as entity_id,
                  c_name as entity_name, group_code,
                  cast(c_nationkey + 10 as integer) as group_id, region_name
           from customer join groups on group_id = c_nationkey""",
        "groups",
    )
)
def municipalities_json_lookup(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "municipalities")
    t.load(spark, folder, "customer").select(
        (F.col("c_custkey") + (10 + F.col("c_nationkey")) * F.lit(10**12)).alias("id"),
        F.col("c_name").alias("nome"),
    ).write.json(path)
    states = readers.read_states(spark, _states_json(spark, folder), E, multi_line=False)
    return readers.read_municipalities(spark, path, states, E, multi_line=False)


@query(sql(WIDE_SQL, "years"))
def entity_sheet_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "sheet")
    sheet = wide_sheet(spark, folder).drop(E.entity)
    bad = sheet.withColumn("CO_MUNICIPIO", F.lit("..."))
    text = sheet.withColumn("CO_MUNICIPIO", F.concat(F.col("CO_MUNICIPIO").cast("string"), F.lit(".0")))
    text.unionByName(bad).write.option("header", True).csv(path)
    return reshape.wide_to_long(readers.read_entity_sheet(spark, path, E), E.entity, E)


GROUP_SHEET_SQL = """
    select group_code, year, cast(target as double) as target, group_code = 'BR' as is_national
    from (select group_code, year, 30 + group_id % 5 + year - 1995 as target from groups, years
          union all select 'BR', year, 40 + year - 1995 from years)"""


@query(sql(GROUP_SHEET_SQL, "groups", "years"))
def group_sheet_csv(spark: SparkSession, folder: str) -> DataFrame:
    """State sheet with footnote marks, a national row without code and a row without name."""
    path = scratch_dir(spark, "group-sheet")
    groups = t.groups(spark, folder)
    yearly = [
        (F.col("base") + (y - t.FIRST_YEAR)).cast("string").alias(f"META_FINAL_{y}") for y in YEARS
    ]
    states = groups.select(
        F.col(E.group_label).alias("NOME_UF"),
        F.concat(F.col(E.group_code), F.lit("* ")).alias("SIGLA_UF"),
        (30 + F.col(E.group) % 5).alias("base"),
    )
    total = groups.agg(
        F.lit("Brasil").alias("NOME_UF"),
        F.lit("-").alias("SIGLA_UF"),
        (F.count(F.lit(1)) * 0 + 40).cast("int").alias("base"),
    )
    unnamed = states.withColumn("NOME_UF", F.lit("--"))
    sheet = states.unionByName(total).unionByName(unnamed)
    sheet.select("NOME_UF", "SIGLA_UF", *yearly).write.option("header", True).csv(path)
    rows = reshape.wide_to_long(readers.read_group_sheet(spark, path, E), E.group_code, E)
    return rows.withColumn("is_national", F.col(E.group_code) == "BR")


@query(sql(WIDE_SQL, "years"))
def titled_sheet_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet as several files, each with a title and a blank line above its header."""
    path = scratch_dir(spark, "titled-sheet")
    sheet = wide_sheet(spark, folder).drop(E.entity)
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sheet.columns]
    rows = sheet.select(
        F.pmod(F.hash("CO_MUNICIPIO"), F.lit(3)).alias("file"), F.lit(3).alias("line"), F.concat_ws(",", *cells).alias("value")
    )
    tops = ["Targets, published", "", ",".join(sheet.columns)]
    above = spark.createDataFrame([(f, k, text) for f in range(3) for k, text in enumerate(tops)], "file int, line int, value string")
    whole = above.unionByName(rows).repartition(3, "file").sortWithinPartitions("file", "line")
    whole.drop("line").write.partitionBy("file").text(path)
    return reshape.wide_to_long(readers.read_entity_sheet(spark, path, E), E.entity, E)


@query(
    sql(
        """select case when group_code = 'BR' then 'national' else 'state' end as side, year as ano, group_code as sigla_uf,
                  cast(target as double) as meta_indicador
           from (select group_code, year, 30.25 + group_id % 5 + year - 1995 as target from groups, years
                 union all select 'BR', year, 40.25 + year - 1995 from years)""",
        "groups",
        "years",
    )
)
def national_and_state_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of the state sheet reconciled once, then divided; the newer one is rounded, so the older is taken."""
    sheets = {}
    groups = t.groups(spark, folder)
    for version, part in ((2023, 0.25), (2025, 0.0)):
        sheets[version] = scratch_dir(spark, f"group-sheet-{version}")
        states = groups.select(
            F.col(E.group_label).alias("NOME_UF"),
            F.col(E.group_code).alias("SIGLA_UF"),
            (30 + F.col(E.group) % 5 + part).alias("base"),
        )
        total = groups.agg(F.lit("Brasil").alias("NOME_UF"), F.lit("").alias("SIGLA_UF"), (F.count(F.lit(1)) * 0 + 40 + part).alias("base"))
        yearly = [(F.col("base") + (y - t.FIRST_YEAR)).cast("string").alias(f"META_FINAL_{y}") for y in YEARS]
        states.unionByName(total).select("NOME_UF", "SIGLA_UF", *yearly).write.option("header", True).csv(sheets[version])
    sides = source_prep.split_national(source_prep.group_targets(spark, sheets))
    named = [rows.withColumn("side", F.lit(side)) for side, rows in zip(("national", "state"), sides, strict=True)]
    return named[0].unionByName(named[1])


@query(sql("select entity_id, row_number() over (order by group_id, entity_id desc) - 1 as place from entities", "entities"))
def export_order(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every row in a sorted CSV export: rows of earlier files, then those before it in its own."""
    path = scratch_dir(spark, "ordered")
    rows = t.entities(spark, folder).withColumn("back", -F.col(E.entity))
    write_csv(rows, path, [E.entity, E.group], [E.group, "back"])
    lines = spark.read.schema(f"{E.entity} bigint, {E.group} int").option("header", True).csv(path)
    file, block = F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")
    read = materialise(lines.select(E.entity, file, block, F.monotonically_increasing_id().alias("n")), "ordered-lines")
    parts = read.groupBy("file", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("file", "block", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return read.join(before, ["file", "block"]).select(E.entity, (F.col("before") + F.col("n") - F.col("first")).alias("place"))


@query(
    f"""select year, entity_id, segment, n as assessed,
               cast(round_even(n * w_flag / nullif(w, 0), 0) as bigint) as reached,
               round_even(w_score / nullif(w, 0), 1) as mean_score
        from (select cast(year(l_shipdate) as integer) as year, l_suppkey as entity_id,
                     l_linenumber % 5 as code, any_value({NETWORK_SQL}) as segment,
                     count(*) as n, sum(w)::double as w,
                     coalesce(sum(w * (l_returnflag = 'R')::integer), 0)::double as w_flag,
                     coalesce(sum(w * cast(l_quantity as bigint)), 0)::double as w_score
              from (select *, 100 + cast(round(l_discount * 100) as bigint) as w from lineitem)
              where l_linestatus = 'F' and l_tax < 0.07
              group by all)"""
)
def microdata_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Semicolon-separated latin-1 files per year, of two column orders, with more columns than needed."""
    path = scratch_dir(spark, "microdata")
    lines = t.load(spark, folder, "lineitem")
    rows = lines.select(
        F.year("l_shipdate").alias("year"),
        F.lit("avaliação").alias("NO_PROVA"),
        (F.col("l_returnflag") == "R").cast("int").alias("IN_ALFABETIZADO"),
        (F.col("l_linenumber") % 5 + 1).alias("TP_DEPENDENCIA"),
        F.col("l_suppkey").alias("CO_MUNICIPIO"),
        (F.col("l_linestatus") == "F").cast("int").alias("IN_PRESENCA_LP"),
        (F.col("l_tax") < 0.07).cast("int").alias("IN_PREENCHIMENTO_LP"),
        (100 + F.round(F.col("l_discount") * 100).cast("bigint")).alias("VL_PESO_ALUNO_LP"),
        F.col("l_quantity").cast("bigint").alias("VL_PROFICIENCIA_LP"),
    )
    options = {"header": True, "sep": ";", "encoding": "ISO-8859-1"}
    early, late = rows.filter("year < 1998"), rows.filter("year >= 1998")
    turned = late.select(*reversed(late.columns))
    for part in (early, turned):
        part.write.mode("append").partitionBy("year").options(**options).csv(path)
    return weighted_microdata(readers.read_microdata(spark, path, E), E)


# --- streams --------------------------------------------------------------------------


def _line_files(spark: SparkSession, folder: str, parts: int | None = None) -> str:
    path = scratch_dir(spark, "lines")
    lines = t.event_lines(spark, folder)
    (lines.repartition(parts, "value") if parts else lines).write.text(path)
    return path


@query(sql(EVENTS_SQL, "event_rows"))
def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_dir(spark, "landing")
    lines = ev.read_lines(spark, _line_files(spark, folder), max_files=10)
    landing = ev.land(
        lines, f"{root}/landed", f"{root}/checkpoint", "2026-01-05", ev.ALL_AVAILABLE
    )
    landing.awaitTermination()
    landed = readers.read_event_lines(spark, f"{root}/landed", names=E)
    valid = landed.filter(F.col(readers.CORRUPT).isNull())
    return typed(valid, measure_spec(E), keep=["event_id"])


@query("select count(*) as lines, 20 as longest from events where event_type = 'view'")
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_dir(spark, "quarantine")
    lines = ev.read_lines(spark, _line_files(spark, folder))
    broken = ev.quarantine(lines, f"{root}/kept", f"{root}/checkpoint", E, ev.ALL_AVAILABLE)
    broken.awaitTermination()
    kept = spark.read.text(f"{root}/kept")
    return kept.agg(F.count(F.lit(1)).alias("lines"), F.max(F.length("value")).alias("longest"))


@query(
    """select case when event_type = 'view' then 'apart' else 'landed' end as side, count(*) as lines,
              cast(count(*) as bigint) as distinct_lines
       from events group by 1"""
)
def stream_land_apart(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed and malformed lines set apart by one stream; its last micro-batch is then written again."""
    root = scratch_dir(spark, "apart")
    lines = ev.read_lines(spark, _line_files(spark, folder, parts=6), max_files=3)
    paths = {"landed": f"{root}/landed", "apart": f"{root}/apart"}
    query = ev.land_apart(lines, *paths.values(), f"{root}/checkpoint", "2026-01-05", E, ev.ALL_AVAILABLE)
    query.awaitTermination()
    found = None
    for side, path in paths.items():
        last = spark.read.text(path)
        repeated = materialise(last.filter(F.col("batch_id") == spark.read.text(path).agg(F.max("batch_id")).scalar()), "repeated")
        ev.write_batch(repeated, path)
        counted = spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("value").alias("distinct_lines"))
        counted = counted.withColumn("side", F.lit(side))
        found = counted if found is None else found.unionByName(counted)
    return found


@query(
    """select 'InputRows' as metric, cast(count(*) as double) as value from events
       union all select 'event_invariant.rows', count(*) from events where event_type <> 'view'
       union all select 'event_invariant.reached_above_assessed', 0
       union all select 'StageSuccess', 1"""
)
def stream_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream of running sums reported, read back from the run metrics."""
    root = scratch_dir(spark, "stream-metrics")
    lines = ev.read_lines(spark, _line_files(spark, folder), max_files=3)
    measures = ev.measurements(valid_events(lines, E), E)
    with StreamMetrics(spark, f"{root}/run_metrics", "totals"):
        totals.keep_totals(measures, f"{root}/totals", f"{root}/checkpoint", E, ev.ALL_AVAILABLE).awaitTermination()
    saved = spark.read.parquet(f"{root}/run_metrics").filter("stage = 'totals'")
    told = saved.filter(F.col("metric").isin("InputRows", "StageSuccess") | F.col("metric").startswith("event_invariant"))
    return told.groupBy("metric").agg(F.sum("value").alias("value"))


@query(
    sql(
        """select g.year, g.entity_id, group_code, g.segment, g.assessed, g.reached, g.mean_score, g.indicator_pct
           from alone g left join dimension d on g.entity_id = d.entity_id""",
        "batch",
        "dimension",
        alone="""select year, entity_id, segment, cast(sum(assessed) as bigint) as assessed,
                        cast(sum(reached) as bigint) as reached,
                        round(sum(mean_score * assessed) / nullif(sum(assessed), 0), 1) as mean_score,
                        round(100::double * cast(sum(reached) as bigint) / nullif(cast(sum(assessed) as bigint), 0), 1)
                          as indicator_pct
                 from batch where year is not null and entity_id is not null and segment is not null group by 1, 2, 3""",
    )
)
def stream_of_blank_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose lines are all blank lands nothing and adds nothing to the batch."""
    root = scratch_dir(spark, "blank")
    t.load(spark, folder, "events").select(F.lit("  ").alias("value")).write.text(f"{root}/lines")
    lines = ev.read_lines(spark, f"{root}/lines")
    ev.land(lines, f"{root}/landed", f"{root}/mark", "2026-01-05", ev.ALL_AVAILABLE).awaitTermination()
    landed = ev.read_lines(spark, f"{root}/lines")
    measures = ev.measurements(valid_events(landed, E), E)
    totals.keep_totals(measures, f"{root}/totals", f"{root}/totals-mark", E, ev.ALL_AVAILABLE).awaitTermination()
    streamed = totals.read_totals(spark, f"{root}/totals", E)
    events = readers.read_event_lines(spark, f"{root}/landed", names=E)
    both = streamed.unionByName(grain_sums(typed(events.drop(readers.CORRUPT), measure_spec(E)), E))
    sums = totals.add_stream(grain_sums(t.batch(spark, folder), E), both, E)
    return enrich(finish(sums, E), t.dimension(spark, folder), E).select(
        E.year, E.entity, E.group_code, E.segment, E.assessed, E.reached, E.score, E.pct
    )


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.readStream.schema(t.SCHEMAS["events"])
    return reader.parquet(f"{folder.rstrip('/')}/events.parquet*")


@query(sql("select * from integrated", "integrated"))
def stream_integrate(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed running sums added to the batch sums at one grain."""
    root = scratch_dir(spark, "totals")
    number = F.from_json("props", "k bigint").getField("k").alias("k")
    events = _event_stream(spark, folder).select("event_id", "user_id", "value", number)
    running = totals.keep_totals(
        t.measured_events(events), f"{root}/totals", f"{root}/checkpoint", E, ev.ALL_AVAILABLE
    )
    running.awaitTermination()
    totals.snapshot_totals(spark, f"{root}/totals", E)
    streamed = totals.read_totals(spark, f"{root}/totals", E)
    sums = totals.add_stream(grain_sums(t.batch(spark, folder), E), streamed, E)
    return enrich(finish(sums, E), t.dimension(spark, folder), E)


@query(
    """select cast(event_id as varchar) as event_id, user_id, event_type, value from events
       where event_type <> 'error'
       union all
       select null, user_id, event_type, value from events, range(2) where event_type = 'error'"""
)
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice; those without an id are all kept."""
    root = scratch_dir(spark, "dedup")
    twice = (
        _event_stream(spark, folder)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(1))))
        .select(
            F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias(
                "event_id"
            ),
            F.col("ts").cast("string").alias("event_time"),
            "user_id",
            "event_type",
            "value",
        )
    )
    once = (
        ev.drop_redelivered(twice, "60 days")
        .drop("event_time")
        .writeStream.format("parquet")
        .option("path", f"{root}/events")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    once.awaitTermination()
    return spark.read.schema(
        "event_id string, user_id bigint, event_type string, value double"
    ).parquet(f"{root}/events")


# --- the layered run ------------------------------------------------------------------


def _prepared(
    spark: SparkSession,
    folder: str,
    root: str,
    date: str,
    lines: DataFrame | None = None,
    seeds: str | None = None,
    **changed: DataFrame,
) -> Run:
    """A run over sources exported from the tables, of which some may be changed.

    With ``seeds``, a folder where they lie already, only those that are changed are exported.
    """
    lake = Lake(f"{root}/lake")
    renamed = dict(zip(dataclasses.astuple(E), dataclasses.astuple(DOMAIN), strict=True))
    sources = dict(changed)
    if seeds is None:
        sources = {
            "uf": t.groups(spark, folder),
            "municipio": t.entities(spark, folder),
            "meta_brasil": t.group_targets(spark, folder).groupBy(E.year).agg(
                F.round(F.max(E.target), 1).alias(E.target)
            ),
            "meta_uf": t.group_targets(spark, folder),
            "meta_municipio": t.entity_targets(spark, folder),
            "alunos": t.batch(spark, folder),
            **changed,
        }
    if seeds is None or changed:
        seeds = f"{root}/seeds-{date}"
    exports = []
    for name, rows in sources.items():
        rows = rows.withColumnsRenamed(renamed)
        exports.append(partial(write_csv, rows, f"{seeds}/{name}.csv", rows.columns))
    events = lake.path("bronze", EVENT_TABLE)
    lines = t.event_lines(spark, folder, DOMAIN) if lines is None else lines
    exports.append(partial(lines.write.mode("overwrite").text, f"{events}/ingestion_date={date}"))
    run = Run(spark, lake, date, seeds)
    together(run, exports)
    return run


def _layered_run(spark: SparkSession, folder: str) -> Run:
    """Bronze, silver, gates and gold. Every query has a run of its own: kept for others, it would be the
    work of whichever came first, and what the others take would not be told by their own figures."""
    run = _prepared(spark, folder, scratch_dir(spark, "lake"), "2026-01-05")
    run_stages(run)
    return run


# Lines cut short are no events: the run counts them and keeps them apart.
_WHOLE_EVENTS = {"stream": t.SQL["stream"] + " where event_type <> 'view'"}


def _run_sql(text: str, *needs: str) -> str:
    whole = sql(text, *needs)
    return whole.replace(t.SQL["stream"], _WHOLE_EVENTS["stream"])


@query(
    _run_sql(
        """select year as ano, group_code as sigla_uf, region_name as nome_regiao,
                  assessed as qtd_avaliados, reached as qtd_alfabetizados,
                  indicator_pct as indicador_pct, group_target as meta_uf,
                  met_target as atingiu_meta, gap_pp as gap_meta_pp
           from comparison""",
        "comparison",
    )
)
def layered_run_group_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return _layered_run(spark, folder).lake.read(spark, "gold", "comparacao_meta_uf")


@query(
    _run_sql(
        """select year as ano, entity_id as id_municipio, entity_name as nome_municipio,
                  group_code as sigla_uf, region_name as nome_regiao,
                  indicator_pct as indicador_pct, previous_pct as indicador_ano_anterior,
                  change_pp as variacao_pp
           from evolution""",
        "evolution",
    )
)
def layered_run_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return _layered_run(spark, folder).lake.read(spark, "gold", "evolucao_temporal")


@query("select count(*) as lines, 20 as longest from events where event_type = 'view'")
def layered_run_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Event lines the run set apart, kept whole."""
    lake = _layered_run(spark, folder).lake
    kept = lake.read_newest(spark, "bronze", f"{QUARANTINE}/{EVENT_TABLE}")
    return kept.agg(F.count(F.lit(1)).alias("lines"), F.max(F.length("line")).alias("longest"))


@query(
    _run_sql(
        """select i.year as ano, i.entity_id as id_municipio, i.region_name as nome_regiao,
                  i.indicator_pct as indicador_pct, entity_target as meta_municipio,
                  gap_pp as gap_meta_pp, change_pp as variacao_pp
           from indicator i join evolution e on i.year = e.year and i.entity_id = e.entity_id
           where i.year = 1997""",
        "indicator",
        "evolution",
    )
)
def layered_run_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the registered Gold tables; the year prunes both to one partition."""
    database = f"gold_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, _layered_run(spark, folder).lake, "gold", database)
    return spark.sql(
        f"""
        select m.ano, m.id_municipio, m.nome_regiao, m.indicador_pct, m.meta_municipio,
               m.gap_meta_pp, s.variacao_pp
        from {database}.indicador_municipio m
        left join {database}.evolucao_temporal s using (ano, id_municipio)
        where m.ano = 1997
        """
    )


@query(
    _run_sql(
        """select layer as stage, name as "table", cast(n as double) as value from (
             select 'bronze' as layer, 'uf' as name, (select count(*) from groups) as n
             union all select 'bronze', 'municipio', (select count(*) from entities)
             union all select 'bronze', 'meta_brasil',
               (select count(distinct year) from group_targets)
             union all select 'bronze', 'meta_uf', (select count(*) from group_targets)
             union all select 'bronze', 'meta_municipio', (select count(*) from entity_targets)
             union all select 'bronze', 'alunos', (select count(*) from batch)
             union all select 'silver', 'uf', (select count(*) from groups)
             union all select 'silver', 'municipio', (select count(*) from entities)
             union all select 'silver', 'meta_brasil',
               (select count(distinct year) from group_targets)
             union all select 'silver', 'meta_uf', (select count(*) from group_targets)
             union all select 'silver', 'meta_municipio', (select count(*) from entity_targets)
             union all select 'silver', 'alunos', (select count(*) from integrated)
             union all select 'gold', 'dim_municipio', (select count(*) from entities)
             union all select 'gold', 'fato_alfabetizacao', (select count(*) from integrated)
             union all select 'gold', 'indicador_municipio', (select count(*) from consolidated)
             union all select 'gold', 'evolucao_temporal', (select count(*) from consolidated)
             union all select 'gold', 'comparacao_meta_uf', (select count(*) from comparison))""",
        "groups",
        "entities",
        "group_targets",
        "entity_targets",
        "integrated",
        "comparison",
    )
)
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows landed and written per table, as the run itself observed them."""
    run = _layered_run(spark, folder)
    saved = spark.read.parquet(f"{run.lake.root}/run_metrics")
    return saved.filter(F.col("metric").isin("RecordsIngested", "RecordsWritten")).select(
        "stage", F.col("dimensions")["table"].alias("table"), "value"
    )


@query(
    _run_sql(
        """select year as ano, entity_id as id_municipio, segment as rede, indicator_pct as indicador_pct,
                  cast(null as double) as meta_municipio, cast(null as boolean) as atingiu_meta
           from integrated""",
        "integrated",
    )
)
def empty_targets_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run whose municipal targets are empty: facts without targets."""
    targets = t.entity_targets(spark, folder)
    root = scratch_dir(spark, "empty-targets")
    run = _prepared(spark, folder, root, "2026-01-05", meta_municipio=targets.filter("false"))
    run_stages(run)
    fact = run.lake.read(spark, "gold", "fato_alfabetizacao")
    return fact.select("ano", "id_municipio", "rede", "indicador_pct", "meta_municipio", "atingiu_meta")


@query(
    sql(
        "select year as ano, group_code as sigla_uf, target as meta_indicador from group_targets",
        "group_targets",
    )
)
def backfill_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two dates, then the first again: it uses its own snapshot, not the newer one."""
    root = scratch_dir(spark, "backfill")
    targets = t.group_targets(spark, folder)
    first = _prepared(spark, folder, root, "2026-01-01")
    fewer = targets.filter(f"{E.year} < 1998")
    later = _prepared(spark, folder, root, "2026-01-02", seeds=first.seeds, meta_uf=fewer)
    run_stages(first, ["bronze", "silver"])
    # The later date has group targets of its own and all other sources from where the first has them.
    others = [name for name in BATCH_TABLES if name != "meta_uf"]
    run_stages(dataclasses.replace(later, seeds=first.seeds, metrics=RunMetrics()), ["bronze"], others)
    run_stages(later, ["bronze", "silver"], ["meta_uf"])
    run_stages(first, ["bronze", "silver"])
    return first.lake.read(spark, "silver", "meta_uf")


@query(
    _run_sql(
        """select year as ano, entity_id as id_municipio, segment as rede, assessed as qtd_avaliados,
                  reached as qtd_alfabetizados, mean_score as media_proficiencia, indicator_pct as indicador_pct
           from integrated""",
        "integrated",
    )
)
def incremental_silver_run(spark: SparkSession, folder: str) -> DataFrame:
    """Events of three dates, a run after each: every run adds the folders that are new to the sums it finds."""
    root = scratch_dir(spark, "incremental")
    lake = Lake(f"{root}/lake")
    numbered = t.event_lines(spark, folder, DOMAIN).withColumn("part", F.pmod(F.hash("value"), F.lit(3)))
    seeds = None
    for k, date in enumerate(("2026-01-01", "2026-01-02", "2026-01-03")):
        run = _prepared(spark, folder, root, date, numbered.filter(F.col("part") == k).select("value"), seeds)
        seeds = run.seeds  # the same sources for every date
        run_stages(run, ["bronze", "silver"])
    return lake.read(spark, "silver", "alunos").select(
        "ano", "id_municipio", "rede", "qtd_avaliados", "qtd_alfabetizados", "media_proficiencia", "indicador_pct"
    )


@query(
    """select cast(year(o_orderdate) as integer) as year, count(*) as n,
              cast(sum(o_custkey + case when year(o_orderdate) = 1996 then 1 else 0 end) as bigint) as keys,
              year(o_orderdate) not in (1996) as files_kept
       from orders where year(o_orderdate) <> 1998 group by all"""
)
def changed_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A yearly table written three times: as it is, the same in another order, then one year changed and one gone.

    Tells for each year whether its first files are still there.
    """
    path = scratch_dir(spark, "changed-table")
    orders = t.load(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    moved = orders.withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("year") == 1996, 1).otherwise(0))
    write_changed(orders, path, "year", ["o_orderkey"])
    first = materialise(_year_files(spark, path), "files")
    write_changed(orders.orderBy("o_totalprice"), path, "year", ["o_orderkey"])
    write_changed(moved.filter("year <> 1998"), path, "year", ["o_orderkey"])
    kept = first.join(_year_files(spark, path), ["year", "file"]).select("year").distinct()
    sums = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))
    return sums.join(kept.withColumn("files_kept", F.lit(True)), "year", "left").fillna(False, ["files_kept"])


def _year_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("year", F.col("_metadata.file_name").alias("file")).distinct()


@query(sql(EVENTS_SQL, "event_rows"))
def event_files_write(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended as JSON files below their date and read back."""
    path = scratch_dir(spark, "event-files")
    write_json_lines(valid_events(t.event_lines(spark, folder), E), path, "2026-01-05")
    landed = readers.read_event_lines(spark, path, names=E)
    return typed(landed.filter(F.col(readers.CORRUPT).isNull()), measure_spec(E), keep=["event_id"])


@query(
    sql(
        """select 'municipio.chave_unica' as rule
           where exists (select entity_id from (select * from entities union all select * from entities)
                         group by entity_id having count(*) > 1)
           union all
           select 'alunos.alfabetizados_leq_avaliados' where exists (select 1 from integrated where assessed + 1 > assessed)""",
        "entities",
        "integrated",
    )
)
def failing_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the critical rules that stop a run whose entities repeat and whose counts are wrong."""
    entities = t.entities(spark, folder)
    frames = {
        "uf": t.groups(spark, folder),
        "municipio": entities.union(entities),
        "alunos": t.integrated(spark, folder).withColumn(E.reached, F.col(E.assessed) + 1),
        "meta_municipio": t.entity_targets(spark, folder),
    }
    try:
        gate(check_all(silver_suite(E), frames))
        failed = []
    except QualityGateError as error:
        failed = str(error).partition(": ")[2].split(", ")
    return spark.createDataFrame([(name,) for name in failed], "rule string")
