"""Mapping of the driver's tables to groups, entities, measurements, events and targets.

``SQL`` holds the same definitions as named common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardline.names import Names
from yardline.operators import marts
from yardline.operators.integrate import integrate

E = Names(
    year="year",
    entity="entity_id",
    entity_label="entity_name",
    group="group_id",
    group_code="group_code",
    group_label="group_name",
    region_id="region_id",
    region="region_name",
    segment="segment",
    assessed="assessed",
    reached="reached",
    score="mean_score",
    pct="indicator_pct",
    target="target",
    entity_target="entity_target",
    group_target="group_target",
    met="met_target",
    gap="gap_pp",
    previous="previous_pct",
    change="change_pp",
)

FIRST_YEAR, LAST_YEAR = 1995, 2001

# The order priorities in lower case, in the order of the number events carry.
SEGMENTS = ("1-urgent", "2-high", "3-medium", "4-not specified", "5-low")


# Declared, so that no query starts with a job that reads footers to infer a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name])
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def groups(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(
        F.col("n_nationkey").alias(E.group),
        F.upper(F.trim("n_name")).alias(E.group_code),
        F.trim("n_name").alias(E.group_label),
        F.col("r_regionkey").alias(E.region_id),
        F.trim("r_name").alias(E.region),
    )


def entities(spark: SparkSession, folder: str) -> DataFrame:
    codes = groups(spark, folder).select(E.group, E.group_code)
    customer = load(spark, folder, "customer").select(
        F.col("c_custkey").alias(E.entity),
        F.trim("c_name").alias(E.entity_label),
        F.col("c_nationkey").alias(E.group),
    )
    return customer.join(codes, E.group, "left").select(
        E.entity, E.entity_label, E.group_code, E.group
    )


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    return marts.dimension(entities(spark, folder), groups(spark, folder), E)


def batch(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are summed per order before the join: four times fewer rows are shuffled,
    and an order with very many lines is one row per task."""
    quantity = F.col("l_quantity").cast("bigint")
    returned = F.when(F.col("l_returnflag") == "R", quantity).otherwise(F.lit(0))
    per_order = (
        load(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(quantity).alias(E.assessed),
            F.sum(returned).alias(E.reached),
            F.max(F.floor("l_extendedprice")).alias(E.score),
        )
    )
    orders = load(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias(E.year),
        F.col("o_custkey").alias(E.entity),
        F.lower(F.trim("o_orderpriority")).alias(E.segment),
    )
    return (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        .groupBy(*E.grain)
        .agg(
            F.sum(E.assessed).alias(E.assessed),
            F.sum(E.reached).alias(E.reached),
            F.max(E.score).cast("double").alias(E.score),
        )
    )


def numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number from their properties, parsed once per row."""
    number = F.from_json("props", "k bigint").getField("k").alias("k")
    return load(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value", number)


def event_fields() -> dict[str, Column]:
    """Event columns from ``numbered_events``."""
    number = F.col("k")
    value = F.floor("value").cast("bigint")
    segment = F.element_at(
        F.array(*[F.lit(s) for s in SEGMENTS]), (F.col("event_id") % 5 + 1).cast("int")
    )
    return {
        E.year: (F.lit(FIRST_YEAR) + F.col("event_id") % 7).cast("int"),
        E.entity: F.col("user_id"),
        E.segment: segment,
        E.assessed: number + 1,
        E.reached: F.greatest(F.lit(0), F.least(number, value)),
        E.score: value.cast("double"),
    }


def measured_events(events: DataFrame) -> DataFrame:
    return events.select(*[c.alias(n) for n, c in event_fields().items()])


def stream(spark: SparkSession, folder: str) -> DataFrame:
    return measured_events(numbered_events(spark, folder))


def event_lines(spark: SparkSession, folder: str, names: Names = E) -> DataFrame:
    """Every event as one JSON line; the lines of one event type are cut short."""
    fields = event_fields()
    record = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("event_time"),
        F.lit("medicao").alias("event_type"),
        *[fields[a].alias(b) for a, b in zip(E.measures, names.measures, strict=True)],
    )
    line = F.to_json(record)
    cut = F.col("event_type") == "view"
    return numbered_events(spark, folder).select(
        F.when(cut, F.substring(line, 1, 20)).otherwise(line).alias("value")
    )


def years() -> Column:
    return F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))).alias(E.year)


def entity_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a negative balance have no target."""
    rows = load(spark, folder, "customer").filter("c_acctbal >= 0")
    value = F.lit(30.0) + F.col("c_custkey") % 7 + 0.5 * (F.col(E.year) - FIRST_YEAR)
    return rows.select("c_custkey", years()).select(
        E.year, F.col("c_custkey").alias(E.entity), value.alias(E.target)
    )


def group_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of one region have no target."""
    rows = groups(spark, folder).filter(F.col(E.region) != "AFRICA")
    value = F.lit(30.0) + F.col(E.group) % 5 + 0.5 * (F.col(E.year) - FIRST_YEAR)
    return rows.select(E.group, E.group_code, years()).select(
        E.year, E.group_code, value.alias(E.target)
    )


def integrated(spark: SparkSession, folder: str) -> DataFrame:
    return integrate(
        batch(spark, folder), stream(spark, folder), dimension(spark, folder), E
    )


def consolidated(spark: SparkSession, folder: str) -> DataFrame:
    return marts.consolidated(integrated(spark, folder), E)


def indicator(spark: SparkSession, folder: str) -> DataFrame:
    return marts.indicator(consolidated(spark, folder), entity_targets(spark, folder), E)


def evolution(spark: SparkSession, folder: str) -> DataFrame:
    return marts.evolution(consolidated(spark, folder), E)


def comparison(spark: SparkSession, folder: str) -> DataFrame:
    return marts.group_comparison(
        consolidated(spark, folder), group_targets(spark, folder), E
    )


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return marts.fact(integrated(spark, folder), entity_targets(spark, folder), E)


SQL = {
    "groups": """
        select n_nationkey as group_id, upper(trim(n_name)) as group_code,
               trim(n_name) as group_name, r_regionkey as region_id, trim(r_name) as region_name
        from nation join region on n_regionkey = r_regionkey""",
    "entities": """
        select c_custkey as entity_id, trim(c_name) as entity_name, group_code,
               c_nationkey as group_id
        from customer left join groups on group_id = c_nationkey""",
    "dimension": """
        select entity_id, entity_name, e.group_code, e.group_id, group_name, region_name
        from entities e left join groups g on e.group_id = g.group_id""",
    "batch": """
        select cast(year(o_orderdate) as integer) as year, o_custkey as entity_id,
               lower(trim(o_orderpriority)) as segment,
               cast(sum(cast(l_quantity as bigint)) as bigint) as assessed,
               cast(sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end)
                    as bigint) as reached,
               cast(max(floor(l_extendedprice)) as double) as mean_score
        from lineitem join orders on l_orderkey = o_orderkey
        group by 1, 2, 3""",
    "event_rows": """
        select event_id, ts, event_type,
               cast(1995 + event_id % 7 as integer) as year, user_id as entity_id,
               case event_id % 5 when 0 then '1-urgent' when 1 then '2-high'
                    when 2 then '3-medium' when 3 then '4-not specified' else '5-low' end
                    as segment,
               k + 1 as assessed,
               greatest(0, least(k, cast(floor(value) as bigint))) as reached,
               cast(floor(value) as double) as mean_score
        from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)""",
    "stream": """
        select year, entity_id, segment, assessed, reached, mean_score from event_rows""",
    "years": "select cast(y as integer) as year from range(1995, 2002) r(y)",
    "entity_targets": """
        select year, c_custkey as entity_id,
               cast(30.0 + c_custkey % 7 + 0.5 * (year - 1995) as double) as target
        from customer, years where c_acctbal >= 0""",
    "group_targets": """
        select year, group_code,
               cast(30.0 + group_id % 5 + 0.5 * (year - 1995) as double) as target
        from groups, years where region_name <> 'AFRICA'""",
    "grain": """
        select year, entity_id, segment, cast(sum(assessed) as bigint) as assessed,
               cast(sum(reached) as bigint) as reached,
               round(sum(mean_score * assessed) / nullif(sum(assessed), 0), 1) as mean_score,
               round(100::double * cast(sum(reached) as bigint)
                     / nullif(cast(sum(assessed) as bigint), 0), 1) as indicator_pct
        from (select * from batch union all by name select * from stream)
        where year is not null and entity_id is not null and segment is not null
        group by 1, 2, 3""",
    "integrated": """
        select year, g.entity_id, entity_name, group_code, group_id, group_name, region_name,
               segment, assessed, reached, mean_score, indicator_pct
        from grain g left join dimension d on g.entity_id = d.entity_id""",
    "consolidated": """
        select year, entity_id, entity_name, group_code, group_id, region_name,
               cast(sum(assessed) as bigint) as assessed, cast(sum(reached) as bigint) as reached,
               round(100::double * cast(sum(reached) as bigint)
                     / nullif(cast(sum(assessed) as bigint), 0), 1) as indicator_pct
        from integrated group by all""",
    "indicator": """
        select c.*, target as entity_target, indicator_pct >= target as met_target,
               round(indicator_pct - target, 1) as gap_pp
        from consolidated c left join entity_targets t
          on c.year = t.year and c.entity_id = t.entity_id""",
    "evolution": """
        select year, entity_id, entity_name, group_code, region_name, indicator_pct,
               previous_pct, round(indicator_pct - previous_pct, 1) as change_pp
        from (select *, lag(indicator_pct) over (partition by entity_id order by year)
                     as previous_pct from consolidated)""",
    "comparison": """
        select s.*, target as group_target, indicator_pct >= target as met_target,
               round(indicator_pct - target, 1) as gap_pp
        from (select year, group_code, region_name,
                     cast(sum(assessed) as bigint) as assessed,
                     cast(sum(reached) as bigint) as reached,
                     round(100::double * cast(sum(reached) as bigint)
                           / nullif(cast(sum(assessed) as bigint), 0), 1) as indicator_pct
              from consolidated group by all) s
        left join group_targets t on s.year = t.year and s.group_code = t.group_code""",
    "fact": """
        select i.* exclude (group_name), target as entity_target,
               indicator_pct >= target as met_target,
               round(indicator_pct - target, 1) as gap_pp
        from integrated i left join entity_targets t
          on i.year = t.year and i.entity_id = t.entity_id""",
}

_NEEDS = {
    "entities": ("groups",),
    "dimension": ("entities", "groups"),
    "stream": ("event_rows",),
    "entity_targets": ("years",),
    "group_targets": ("groups", "years"),
    "grain": ("batch", "stream"),
    "integrated": ("grain", "dimension"),
    "consolidated": ("integrated",),
    "indicator": ("consolidated", "entity_targets"),
    "evolution": ("consolidated",),
    "comparison": ("consolidated", "group_targets"),
    "fact": ("integrated", "entity_targets"),
}


def sql(query: str, *needs: str, **extra: str) -> str:
    """``query`` preceded by the expressions it needs, and by ``extra`` ones of its own."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        for below in _NEEDS.get(name, ()):
            add(below)
        ordered.setdefault(name, SQL[name])

    for name in needs:
        add(name)
    ordered.update(extra)
    if not ordered:
        return query
    named = ",\n".join(f"{name} as ({text})" for name, text in ordered.items())
    return f"with {named}\n{query}"
