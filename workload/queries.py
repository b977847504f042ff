"""One query per operator, each with the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload import tables as t
from workload.tables import E, sql
from yardline.functions import code_label, gap, met_target, percentage, weighted_mean
from yardline.operators import checks, marts, microdata, reshape
from yardline.operators.clean import clean, typed
from yardline.operators.events import valid_events
from yardline.operators.integrate import (
    SCORE_SUM,
    SCORE_WEIGHT,
    add_sums,
    enrich,
    finish,
    first_per_event,
    grain_sums,
)
from yardline.plans import reports
from yardline.plans.suite import gold_suite, silver_suite
from yardline.session import materialise
from yardline.sources.readers import with_parent
from yardline.streaming import events as ev
from yardline.tables import Field, entity_spec, group_spec, measure_spec, target_spec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
YEAR = 1997


def query(oracle: str | None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


# --- clean layer ----------------------------------------------------------------------


def _variants(rows: DataFrame, *selects: list[str]) -> DataFrame:
    frames = [rows.selectExpr(*s) for s in selects]
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united.withColumn("ingested_at", F.to_timestamp("ingested_at"))


# Raw copies of every row: newest, equally new with another label, older, unusable id,
# missing code. The same lists make the SQL of the oracle.
GROUP_COPIES = [
    ["concat(' ', cast(group_id as string), ' ') as group_id",
     "concat(' ', lower(group_code)) as group_code", "concat(group_name, ' ') as group_name",
     "cast(region_id as string) as region_id", "concat(' ', region_name) as region_name",
     "'2026-01-02 00:00:00' as ingested_at"],
    ["cast(group_id as string) as group_id", "group_code", "'zz' as group_name",
     "'x' as region_id", "region_name", "'2026-01-02 00:00:00' as ingested_at"],
    ["cast(group_id as string) as group_id", "group_code", "'old' as group_name",
     "cast(region_id as string) as region_id", "region_name",
     "'2026-01-01 00:00:00' as ingested_at"],
    ["concat('n', cast(group_id as string)) as group_id", "group_code", "group_name",
     "cast(region_id as string) as region_id", "region_name",
     "'2026-01-03 00:00:00' as ingested_at"],
    ["cast(group_id as string) as group_id", "cast(null as string) as group_code",
     "group_name", "cast(region_id as string) as region_id", "region_name",
     "'2026-01-03 00:00:00' as ingested_at"],
]
ENTITY_COPIES = [
    ["cast(entity_id as string) as entity_id", "concat('  ', entity_name, ' ') as entity_name",
     "lower(group_code) as group_code", "concat(cast(group_id as string), '.0') as group_id",
     "'2026-01-02 00:00:00' as ingested_at"],
    ["cast(entity_id as string) as entity_id", "concat(entity_name, ' old') as entity_name",
     "group_code", "cast(group_id as string) as group_id",
     "'2026-01-01 00:00:00' as ingested_at"],
    ["concat('x', cast(entity_id as string)) as entity_id", "entity_name", "group_code",
     "cast(group_id as string) as group_id", "'2026-01-03 00:00:00' as ingested_at"],
]
TARGET_COPIES = [
    ["cast(year as string) as year", "cast(entity_id as string) as entity_id",
     "cast(target as string) as target", "'2026-01-02 00:00:00' as ingested_at"],
    ["cast(year as string) as year", "cast(entity_id as string) as entity_id",
     "'none' as target", "'2026-01-01 00:00:00' as ingested_at"],
    ["cast(null as string) as year", "cast(entity_id as string) as entity_id",
     "cast(target as string) as target", "'2026-01-03 00:00:00' as ingested_at"],
]


def _copies_sql(copies: list[list[str]], table: str) -> str:
    return " union all by name ".join(f"select {', '.join(c)} from {table}" for c in copies)


@query(
    sql(
        """select group_id, group_code, group_name, region_id, region_name
           from (select *, row_number() over (partition by group_id
                    order by ingested_at desc nulls last, group_code nulls last,
                             group_name nulls last, region_id nulls last,
                             region_name nulls last) as rn
                 from typed where group_id is not null and group_code is not null)
           where rn = 1""",
        "groups",
        raw=_copies_sql(GROUP_COPIES, "groups"),
        typed="""select try_cast(group_id as integer) as group_id,
                        upper(trim(group_code)) as group_code, trim(group_name) as group_name,
                        try_cast(region_id as integer) as region_id,
                        trim(region_name) as region_name, ingested_at from raw""",
    )
)
def clean_group(spark: SparkSession, folder: str) -> DataFrame:
    return clean(_variants(t.groups(spark, folder), *GROUP_COPIES), group_spec(E))


@query(
    sql(
        """select entity_id, entity_name, group_code, group_id
           from (select *, row_number() over (partition by entity_id
                    order by ingested_at desc nulls last, entity_name nulls last,
                             group_code nulls last, group_id nulls last) as rn
                 from typed where entity_id is not null)
           where rn = 1""",
        "entities",
        raw=_copies_sql(ENTITY_COPIES, "entities"),
        typed="""select try_cast(entity_id as bigint) as entity_id,
                        trim(entity_name) as entity_name, upper(trim(group_code)) as group_code,
                        cast(trunc(try_cast(group_id as double)) as integer) as group_id,
                        ingested_at from raw""",
    )
)
def clean_entity(spark: SparkSession, folder: str) -> DataFrame:
    return clean(_variants(t.entities(spark, folder), *ENTITY_COPIES), entity_spec(E))


@query(
    sql(
        """select year, entity_id, target
           from (select *, row_number() over (partition by year, entity_id
                    order by ingested_at desc nulls last, target nulls last) as rn
                 from typed where year is not null and entity_id is not null)
           where rn = 1""",
        "entity_targets",
        raw=_copies_sql(TARGET_COPIES, "entity_targets"),
        typed="""select try_cast(year as integer) as year,
                        try_cast(entity_id as bigint) as entity_id,
                        try_cast(target as double) as target, ingested_at from raw""",
    )
)
def clean_target(spark: SparkSession, folder: str) -> DataFrame:
    spec = target_spec((Field(E.entity, "bigint"),), E)
    return clean(_variants(t.entity_targets(spark, folder), *TARGET_COPIES), spec)


# --- integration and marts ------------------------------------------------------------


@query(sql("select * from integrated", "integrated"))
def integrate_batch_stream(spark: SparkSession, folder: str) -> DataFrame:
    return t.integrated(spark, folder)


@query(
    """select cast(year(l_shipdate) as integer) as year, l_suppkey as entity_id,
              l_returnflag as segment, cast(sum(w) as bigint) as assessed,
              cast(sum(l_linenumber) as bigint) as reached,
              round(sum(s * w) / nullif(sum(w), 0), 1) as mean_counting_nulls,
              round(sum(s * w) / nullif(sum(case when s is not null then w end), 0), 1)
                  as mean_excluding_nulls,
              round(100::double * cast(sum(l_linenumber) as bigint)
                    / nullif(cast(sum(w) as bigint), 0), 1) as indicator_pct
       from (select *, cast(l_quantity as bigint) as w,
                    case when l_discount > 0 then floor(l_extendedprice) end as s
             from lineitem)
       group by 1, 2, 3"""
)
def weighted_mean_null_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.load(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias(E.year),
        F.col("l_suppkey").alias(E.entity),
        F.col("l_returnflag").alias(E.segment),
        F.col("l_quantity").cast("bigint").alias(E.assessed),
        F.col("l_linenumber").cast("bigint").alias(E.reached),
        F.when(F.col("l_discount") > 0, F.floor("l_extendedprice").cast("double")).alias(E.score),
    )
    sums = grain_sums(rows, E)
    excluding = weighted_mean(F.col(SCORE_SUM), F.col(SCORE_WEIGHT)).alias("mean_excluding_nulls")
    counting = weighted_mean(F.col(SCORE_SUM), F.col(E.assessed)).alias("mean_counting_nulls")
    return sums.select(
        *E.grain,
        E.assessed,
        E.reached,
        counting,
        excluding,
        percentage(F.col(E.reached), F.col(E.assessed)).alias(E.pct),
    )


@query(sql("select * from dimension", "dimension"))
def dim_entity(spark: SparkSession, folder: str) -> DataFrame:
    return t.dimension(spark, folder)


@query(sql("select * from fact", "fact"))
def fact_with_target(spark: SparkSession, folder: str) -> DataFrame:
    return t.fact(spark, folder)


@query(sql("select * from consolidated", "consolidated"))
def consolidate_segments(spark: SparkSession, folder: str) -> DataFrame:
    return t.consolidated(spark, folder)


@query(sql("select * from indicator", "indicator"))
def indicator_vs_target(spark: SparkSession, folder: str) -> DataFrame:
    return t.indicator(spark, folder)


@query(sql("select * from evolution", "evolution"))
def evolution_yoy(spark: SparkSession, folder: str) -> DataFrame:
    return t.evolution(spark, folder)


@query(
    sql(
        """select year, entity_id, entity_name, group_code, region_name, indicator_pct,
                  previous_pct, round(indicator_pct - previous_pct, 1) as change_pp
           from (select c.*, p.indicator_pct as previous_pct
                 from consolidated c left join consolidated p
                   on c.entity_id = p.entity_id and c.year = p.year + 1)""",
        "consolidated",
    )
)
def evolution_adjacent_years(spark: SparkSession, folder: str) -> DataFrame:
    return marts.evolution(t.consolidated(spark, folder), E, strict=True)


@query(sql("select * from comparison", "comparison"))
def target_vs_result_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return t.comparison(spark, folder)


# --- reports --------------------------------------------------------------------------


@query(
    sql(
        f"""select entity_name, group_code, indicator_pct, entity_target, gap_pp
            from indicator where year = {YEAR} order by indicator_pct desc""",
        "indicator",
    )
)
def q_year_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return reports.year_ranking(t.indicator(spark, folder), YEAR, E)


@query(
    sql(
        f"""select entity_name, group_code, indicator_pct, entity_target, gap_pp
            from indicator where year = {YEAR} and gap_pp < 0 order by gap_pp""",
        "indicator",
    )
)
def q_below_target(spark: SparkSession, folder: str) -> DataFrame:
    return reports.below_target(t.indicator(spark, folder), YEAR, E)


@query(
    sql(
        f"""select group_code, region_name, indicator_pct, group_target, met_target, gap_pp
            from comparison where year = {YEAR} order by indicator_pct desc""",
        "comparison",
    )
)
def q_group_result(spark: SparkSession, folder: str) -> DataFrame:
    return reports.group_result(t.comparison(spark, folder), YEAR, E)


SERIES_OF = "Customer#000000007"


@query(
    sql(
        f"""select year, entity_name, indicator_pct, previous_pct, change_pp
            from evolution where entity_name = '{SERIES_OF}' order by year""",
        "evolution",
    )
)
def q_entity_series(spark: SparkSession, folder: str) -> DataFrame:
    return reports.entity_series(t.evolution(spark, folder), SERIES_OF, E)


@query(
    sql(
        f"""select entity_name, group_code, segment, indicator_pct
            from fact where year = {YEAR} order by entity_name, segment""",
        "fact",
    )
)
def q_segment_compare(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_comparison(t.fact(spark, folder), YEAR, E)


@query(
    sql(
        f"""select i.year, i.entity_id, i.region_name, i.indicator_pct, entity_target, gap_pp,
                   change_pp
            from indicator i left join evolution e
              on i.year = e.year and i.entity_id = e.entity_id
            where i.year = {YEAR}""",
        "indicator",
        "evolution",
    )
)
def q_feature_table(spark: SparkSession, folder: str) -> DataFrame:
    total = materialise(t.consolidated(spark, folder), "features")
    indicator = marts.indicator(total, t.entity_targets(spark, folder), E)
    return reports.feature_table(indicator, marts.evolution(total, E), YEAR, E)


@query(
    sql(
        """select year, region_name, grouping(region_name) = 1 as is_total,
                  round(cast(sum(cast(round(indicator_pct * 10) as bigint)) as bigint)
                        / nullif(10.0::double * count(indicator_pct), 0), 1) as mean_pct,
                  count(*) as entities,
                  round(100::double * cast(sum(cast(met_target as integer)) as bigint)
                        / nullif(count(met_target), 0), 0) as met_share
           from indicator group by grouping sets ((year, region_name), (year))""",
        "indicator",
    )
)
def q_region_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.regions(t.indicator(spark, folder), n=E)


# --- quality --------------------------------------------------------------------------

CHECK_COLUMNS = ["name", "severity", "violations", "passed"]


def _check_sql(name: str, violations: str, severity: str = "critical") -> str:
    return f"""select '{name}' as name, '{severity}' as severity,
                      cast(v as bigint) as violations, v = 0 as passed
               from (select {violations} as v)"""


@query(
    _check_sql(
        "orders.key",
        """(select count(*) from (select o_custkey, o_orderdate from orders
            group by all having count(*) > 1))""",
    )
)
def check_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    rule = checks.Unique("orders.key", ("o_custkey", "o_orderdate"))
    return checks.check(t.load(spark, folder, "orders"), [rule]).select(*CHECK_COLUMNS)


@query(
    _check_sql(
        "orders.filled",
        """(select count(*) from orders
            where nullif(o_orderstatus, 'F') is null or nullif(o_orderpriority, '5-LOW') is null)""",
        "warning",
    )
)
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    orders = t.load(spark, folder, "orders").select(
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    rule = checks.Filled("orders.filled", ("status", "priority"), checks.WARNING)
    return checks.check(orders, [rule]).select(*CHECK_COLUMNS)


@query(
    _check_sql(
        "lineitem.order",
        """(select count(*) from (select case l_returnflag when 'R' then -1 - l_orderkey
                                         when 'A' then null else l_orderkey end as k
                                  from lineitem) l
            where not exists (select 1 from orders where o_orderkey = k))""",
    )
)
def check_orphans(spark: SparkSession, folder: str) -> DataFrame:
    key = (
        F.when(F.col("l_returnflag") == "R", -1 - F.col("l_orderkey"))
        .when(F.col("l_returnflag") == "A", F.lit(None))
        .otherwise(F.col("l_orderkey"))
    )
    lines = t.load(spark, folder, "lineitem").select(key.alias("k"))
    rule = checks.Refers("lineitem.order", ("k",), "orders", ("o_orderkey",))
    parents = {"orders": t.load(spark, folder, "orders")}
    return checks.check(lines, [rule], parents).select(*CHECK_COLUMNS)


@query(
    _check_sql(
        "lineitem.discount",
        """(select count(*) from lineitem
            where l_tax > 0 and (l_discount < 0.01 or l_discount > 0.08))""",
    )
)
def check_range(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.load(spark, folder, "lineitem").select(
        F.when(F.col("l_tax") > 0, F.col("l_discount")).alias("discount")
    )
    rule = checks.InRange("lineitem.discount", "discount", 0.01, 0.08)
    return checks.check(lines, [rule]).select(*CHECK_COLUMNS)


@query(
    _check_sql(
        "lineitem.number",
        "(select count(*) from lineitem where l_linenumber > l_quantity)",
    )
)
def check_leq(spark: SparkSession, folder: str) -> DataFrame:
    rule = checks.AtMost("lineitem.number", "l_linenumber", "l_quantity")
    return checks.check(t.load(spark, folder, "lineitem"), [rule]).select(*CHECK_COLUMNS)


SUITE_SQL = """
    select name, 'critical' as severity, cast(v as bigint) as violations, v = 0 as passed
    from (
      select 'municipio.chave_unica' as name, (select count(*) from (select entity_id
          from entities group by all having count(*) > 1)) as v
      union all select 'municipio.sem_nulos', (select count(*) from entities
          where entity_id is null or group_code is null)
      union all select 'municipio.fk_uf', (select count(*) from entities e
          where not exists (select 1 from groups g where g.group_id = e.group_id))
      union all select 'alunos.grao_unico', (select count(*) from (select year, entity_id,
          segment from integrated group by all having count(*) > 1))
      union all select 'alunos.sem_nulos', (select count(*) from integrated
          where year is null or entity_id is null or segment is null or indicator_pct is null)
      union all select 'alunos.indicador_0_100', (select count(*) from integrated
          where indicator_pct < 0 or indicator_pct > 100)
      union all select 'alunos.alfabetizados_leq_avaliados', (select count(*) from integrated
          where reached > assessed)
      union all select 'alunos.fk_municipio', (select count(*) from integrated i
          where not exists (select 1 from entities e where e.entity_id = i.entity_id))
      union all select 'meta_municipio.grao_unico', (select count(*) from (select year,
          entity_id from entity_targets group by all having count(*) > 1))
      union all select 'meta_municipio.fk_municipio', (select count(*) from entity_targets m
          where not exists (select 1 from entities e where e.entity_id = m.entity_id))
      union all select 'gold.indicador_0_100', (select count(*) from indicator
          where indicator_pct < 0 or indicator_pct > 100))"""


@query(sql(SUITE_SQL, "integrated", "entities", "groups", "entity_targets", "indicator"))
def quality_suite(spark: SparkSession, folder: str) -> DataFrame:
    integrated = materialise(t.integrated(spark, folder), "suite")
    targets = t.entity_targets(spark, folder)
    frames = {
        "uf": t.groups(spark, folder),
        "municipio": t.entities(spark, folder),
        "alunos": integrated,
        "meta_municipio": targets,
        "indicador_municipio": marts.indicator(marts.consolidated(integrated, E), targets, E),
    }
    return checks.check_all([*silver_suite(E), *gold_suite(E)], frames).select(*CHECK_COLUMNS)


@query(
    """select count(*) as rows, count(distinct (l_orderkey, l_linenumber)) as keys
       from lineitem"""
)
def grain_counts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.grain_counts(t.load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- events ---------------------------------------------------------------------------

EVENTS_SQL = """select cast(event_id as varchar) as event_id, year, entity_id, segment,
                       assessed, reached, mean_score
                from event_rows where event_type <> 'view'"""


def _typed_events(lines: DataFrame) -> DataFrame:
    """Typed measurements of the parsable lines, with the event id beside them."""
    return typed(valid_events(lines, E), measure_spec(E), keep=["event_id"])


@query(sql(EVENTS_SQL, "event_rows"))
def events_from_json(spark: SparkSession, folder: str) -> DataFrame:
    return _typed_events(t.event_lines(spark, folder))


@query(sql(EVENTS_SQL, "event_rows"))
def events_encoded_decode(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.event_lines(spark, folder)
    records = lines.select(F.base64(F.col("value").cast("binary")).alias("data"))
    return _typed_events(ev.decoded_lines(records))


DEDUP_SQL = """
    select event_id, user_id, event_type, value
    from (select *, row_number() over (partition by event_id order by event_type nulls last,
                                       user_id nulls last, value nulls last) as rn
          from copies where event_id is not null)
    where rn = 1
    union all select event_id, user_id, event_type, value from copies where event_id is null"""


@query(
    sql(
        DEDUP_SQL,
        copies="""select case when event_type = 'error' then null else event_id end as event_id,
                         user_id, event_type, value + copy as value
                  from events, range(3) r(copy)""",
    )
)
def event_dedup(spark: SparkSession, folder: str) -> DataFrame:
    copies = (
        t.load(spark, folder, "events")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .select(
            F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_id"),
            "event_type",
            "user_id",
            (F.col("value") + F.col("copy")).alias("value"),
        )
    )
    return first_per_event(copies).select("event_id", "user_id", "event_type", "value")


# --- reshape, versions, microdata ------------------------------------------------------

YEARS = range(t.FIRST_YEAR, t.LAST_YEAR + 1)


def wide_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly targets of every customer as text columns, with the markers sheets carry."""
    value = F.col("c_custkey") % 7 + 30
    columns = [
        F.when(F.col("c_acctbal") > 9000, F.lit(">80"))
        .when((F.col("c_mktsegment") == "BUILDING") & F.lit(y == YEAR), F.lit("-"))
        .when(F.col("c_acctbal") < 0, F.lit("0"))
        .otherwise(F.concat(F.lit(" "), (value + (y - t.FIRST_YEAR)).cast("string"), F.lit(".25")))
        .alias(f"META_FINAL_{y}")
        for y in YEARS
    ]
    return t.load(spark, folder, "customer").select(
        F.col("c_custkey").alias(E.entity), F.col("c_custkey").alias("CO_MUNICIPIO"), *columns
    )


WIDE_SQL = f"""
    select entity_id, year, target from (
      select c_custkey as entity_id, year,
             cast(case when c_acctbal > 9000 then 80
                       when c_mktsegment = 'BUILDING' and year = {YEAR} then null
                       when c_acctbal < 0 then 0
                       else c_custkey % 7 + 30 + year - 1995 + 0.25 end as double) as target
      from customer, years)
    where target > 0"""


@query(sql(WIDE_SQL, "years"))
def wide_to_long_targets(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.wide_to_long(wide_sheet(spark, folder), E.entity, E)


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    """Three published versions of the customers' targets.

    2023 has two decimals; 2024 lacks the first year for one market segment and is
    shifted for another; 2025 is rounded to integers and lacks a year for negative
    balances.
    """
    rows = t.load(spark, folder, "customer").select(
        F.col("c_custkey").alias(E.entity), "c_mktsegment", "c_acctbal", t.years()
    )
    exact = F.col(E.entity) % 50 + 30 + (F.col(E.year) - t.FIRST_YEAR) + F.lit(0.5) - F.lit(
        0.25
    ) * (F.col(E.entity) % 3)
    segment, year = F.col("c_mktsegment"), F.col(E.year)
    shift = F.when(segment == "MACHINERY", 2).otherwise(0)
    first = rows.select(E.entity, E.year, exact.alias(E.target))
    second = rows.filter((segment != "BUILDING") | (year > t.FIRST_YEAR)).select(
        E.entity, E.year, (exact + shift).alias(E.target)
    )
    third = rows.filter((F.col("c_acctbal") >= 0) | (year < t.LAST_YEAR)).select(
        E.entity, E.year, F.bround(exact + shift, 0).alias(E.target)
    )
    return reshape.stack_versions({2023: first, 2024: second, 2025: third})


@query(
    sql(
        """select entity_id, year, round_even(target, 4) as target from chosen
           join versions using (entity_id, version)""",
        "years",
        customer_years="""select c_custkey as entity_id, c_mktsegment, c_acctbal, year,
              cast(c_custkey % 50 + 30 + year - 1995 + 0.5 - 0.25 * (c_custkey % 3) as double)
                  as exact,
              case when c_mktsegment = 'MACHINERY' then 2 else 0 end as shift
            from customer, years""",
        versions="""select entity_id, year, exact as target, 2023 as version from customer_years
            union all select entity_id, year, exact + shift, 2024 from customer_years
              where c_mktsegment <> 'BUILDING' or year > 1995
            union all select entity_id, year, round_even(exact + shift, 0), 2025
              from customer_years where c_acctbal >= 0 or year < 2001""",
        per_version="""select entity_id, version, count(distinct year) as nd, count(*) as n,
              list(struct_pack(a := year, r := round_even(target, 0)) order by year) as path
            from versions group by all""",
        base="""select entity_id, max(version) as version from per_version
            where nd = (select count(distinct year) from versions) group by all""",
        earlier="""select b.entity_id, min(c.version) as version
            from base b join per_version p using (entity_id, version)
            join per_version c on c.entity_id = b.entity_id and c.version < b.version
              and c.n = p.nd and c.path = p.path
            group by all""",
        chosen="""select b.entity_id, coalesce(e.version, b.version) as version
            from base b left join earlier e on e.entity_id = b.entity_id""",
    )
)
def reconcile_versions(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.reconcile(_versions(spark, folder), E.entity, E)


NETWORK_SQL = """case l_linenumber % 5 when 0 then 'federal' when 1 then 'estadual'
                 when 2 then 'municipal' when 3 then 'privada' end"""


@query(
    f"""select year, entity_id, segment, n as assessed,
               cast(round_even(n * w_flag / nullif(w, 0), 0) as bigint) as reached,
               round_even(w_score / nullif(w, 0), 1) as mean_score
        from (select cast(year(o_orderdate) as integer) as year, o_custkey as entity_id,
                     l_linenumber % 5 as code, any_value({NETWORK_SQL}) as segment,
                     count(*) as n, sum(w)::double as w,
                     coalesce(sum(w * (l_returnflag = 'R')::integer), 0)::double as w_flag,
                     coalesce(sum(w * cast(l_quantity as bigint)), 0)::double as w_score
              from (select *, 100 + cast(round(l_discount * 100) as bigint) as w from lineitem)
              join orders on l_orderkey = o_orderkey
              where l_linestatus = 'F' and l_tax < 0.07
              group by all)"""
)
def microdata_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are summed per order and network before the join with the orders."""
    persons = t.load(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_orderkey").alias("entity"),
        (F.col("l_linenumber") % 5 + 1).alias("network"),
        (F.col("l_linestatus") == "F").cast("int").alias("present"),
        (F.col("l_tax") < 0.07).cast("int").alias("filled"),
        (100 + F.round(F.col("l_discount") * 100).cast("bigint")).alias("weight"),
        F.col("l_quantity").cast("bigint").alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("flag"),
    )
    per_order = microdata.weighted_sums(microdata.counted(persons), ["l_orderkey", "network"])
    orders = t.load(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias(E.year), F.col("o_custkey").alias("entity")
    )
    sums = (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        .groupBy(E.year, "entity", "network")
        .agg(*[F.sum(c).alias(c) for c in ("n", "w", "w_flag", "w_score")])
    )
    return microdata.finish_microdata(sums, E)


@query(
    sql(
        """select year, cast(sum(assessed) as bigint) as assessed,
                  count(distinct entity_id) as entities
           from batch group by year""",
        "batch",
    )
)
def coverage_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return microdata.coverage(t.batch(spark, folder), E)


@query(
    sql(
        """select c_custkey + (10 + c_nationkey) * 1000000000000 as entity_id,
                  trim(c_name) as entity_name, group_code,
                  cast(c_nationkey + 10 as integer) as group_id, region_name
           from customer join groups on group_id = c_nationkey""",
        "groups",
    )
)
def derive_parent_from_id(spark: SparkSession, folder: str) -> DataFrame:
    parents = t.groups(spark, folder).withColumn(E.group, F.col(E.group) + 10)
    rows = t.load(spark, folder, "customer").select(
        (F.col("c_custkey") + (10 + F.col("c_nationkey")) * F.lit(10**12)).alias(E.entity),
        F.trim("c_name").alias(E.entity_label),
    )
    return with_parent(rows, parents, E)


# --- scalar functions -----------------------------------------------------------------


@query(
    """select l_orderkey, l_linenumber,
              round(100::double * cast(l_quantity as bigint)
                    / nullif(l_linenumber - 3, 0), 1) as pct,
              cast(l_quantity as bigint) >= target as met,
              round(cast(l_quantity as bigint) - target, 1) as gap,
              case l_linenumber when 1 then 'federal' when 2 then 'estadual'
                   when 3 then 'municipal' when 4 then 'privada' end as label
       from (select *, case when l_returnflag <> 'N' then l_linenumber * 5 end as target
             from lineitem)"""
)
def measure_functions(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    target = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber") * 5)
    return t.load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        percentage(quantity, F.col("l_linenumber") - 3).alias("pct"),
        met_target(quantity, target).alias("met"),
        gap(quantity, target).alias("gap"),
        code_label(F.col("l_linenumber")).alias("label"),
    )


@query(
    sql(
        """select year, s.entity_id, entity_name, group_code, group_id, group_name, region_name,
                  segment, assessed, reached,
                  round(score_sum / nullif(assessed, 0), 1) as mean_score,
                  round(100::double * reached / nullif(assessed, 0), 1) as indicator_pct
           from (select year, entity_id, segment, cast(sum(assessed) as bigint) as assessed,
                        cast(sum(reached) as bigint) as reached,
                        sum(mean_score * assessed) as score_sum
                 from (select * from batch union all by name select * from stream)
                 group by 1, 2, 3) s
           left join dimension d on d.entity_id = s.entity_id""",
        "batch",
        "stream",
        "dimension",
    )
)
def integrate_partial_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Batch and stream summed apart, then the sums added."""
    parts = grain_sums(t.batch(spark, folder), E).unionByName(
        grain_sums(t.stream(spark, folder), E)
    )
    return enrich(finish(add_sums(parts, E), E), t.dimension(spark, folder), E)
