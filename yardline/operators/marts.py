"""Dimension, fact and mart builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions import gap, met_target, percentage
from yardline.names import DOMAIN, Names


def dimension(entities: DataFrame, groups: DataFrame, names: Names = DOMAIN) -> DataFrame:
    attributes = groups.select(names.group, names.group_label, names.region)
    return entities.join(attributes, names.group, "left").select(
        names.entity,
        names.entity_label,
        names.group_code,
        names.group,
        names.group_label,
        names.region,
    )


def against_target(
    rows: DataFrame, targets: DataFrame, by: str, target_name: str, names: Names = DOMAIN, many: bool = False
) -> DataFrame:
    """Put the yearly target beside each row. The rounded indicator is compared
    with the target as published, and the gap is rounded again.

    ``many``: there are targets for about as many keys as rows. These are joined by sorting, since the size
    of the files they come from tells too little for a broadcast: seven targets a customer, each a hundred
    bytes in a broadcast table, from five bytes of a file.
    """
    keyed = targets.select(names.year, by, F.col(names.target).alias(target_name))
    if many:
        keyed = keyed.hint("merge")
    joined = rows.join(keyed, [names.year, by], "left")
    value, target = F.col(names.pct), F.col(target_name)
    return joined.withColumns(
        {names.met: met_target(value, target), names.gap: gap(value, target)}
    )


def fact(measures: DataFrame, entity_targets: DataFrame, names: Names = DOMAIN) -> DataFrame:
    compared = against_target(
        measures, entity_targets, names.entity, names.entity_target, names, many=True
    )
    return compared.select(
        names.year,
        names.entity,
        names.entity_label,
        names.group_code,
        names.group,
        names.region,
        names.segment,
        names.assessed,
        names.reached,
        names.score,
        names.pct,
        names.entity_target,
        names.met,
        names.gap,
    )


def _summed(rows: DataFrame, by: list[str], names: Names) -> DataFrame:
    return (
        rows.groupBy(*by)
        .agg(
            F.sum(names.assessed).alias(names.assessed),
            F.sum(names.reached).alias(names.reached),
        )
        .withColumn(names.pct, percentage(F.col(names.reached), F.col(names.assessed)))
    )


def consolidated(measures: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """All segments of an entity and year together: ratio of sums, never a mean of ratios."""
    by = [
        names.year,
        names.entity,
        names.entity_label,
        names.group_code,
        names.group,
        names.region,
    ]
    return _summed(measures, by, names)


def indicator(total: DataFrame, entity_targets: DataFrame, names: Names = DOMAIN) -> DataFrame:
    compared = against_target(total, entity_targets, names.entity, names.entity_target, names, many=True)
    return compared.select(
        names.year,
        names.entity,
        names.entity_label,
        names.group_code,
        names.group,
        names.region,
        names.assessed,
        names.reached,
        names.pct,
        names.entity_target,
        names.met,
        names.gap,
    )


def evolution(total: DataFrame, names: Names = DOMAIN, strict: bool = False) -> DataFrame:
    """Change against the previous available year; with ``strict`` against year - 1 only.

    An entity's series goes on when its label changes.
    """
    window = Window.partitionBy(names.entity).orderBy(names.year)
    earlier = F.lag(names.pct).over(window)
    if strict:
        adjacent = F.lag(names.year).over(window) == F.col(names.year) - 1
        earlier = F.when(adjacent, earlier)
    series = total.select(
        names.year,
        names.entity,
        names.entity_label,
        names.group_code,
        names.region,
        names.pct,
        earlier.alias(names.previous),
    )
    return series.withColumn(names.change, gap(F.col(names.pct), F.col(names.previous)))


def group_comparison(
    total: DataFrame, group_targets: DataFrame, names: Names = DOMAIN
) -> DataFrame:
    """Entities of a group summed per year and set against the group target."""
    by_group = _summed(total, [names.year, names.group_code, names.region], names)
    compared = against_target(
        by_group, group_targets, names.group_code, names.group_target, names
    )
    return compared.select(
        names.year,
        names.group_code,
        names.region,
        names.assessed,
        names.reached,
        names.pct,
        names.group_target,
        names.met,
        names.gap,
    )


def region_summary(mart: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Per year and region, with a total row per year: unweighted mean indicator over
    entities, number of entities, share (percent) of those with a target that met it.

    The mean is formed from tenths, which the one-decimal indicator holds exactly, so
    it does not depend on the order of summation. Regions are summed first; the total
    rows come from those few sums.
    """
    met = F.col(names.met).cast("int")
    sums = mart.groupBy(names.year, names.region).agg(
        F.sum(F.round(F.col(names.pct) * 10).cast("bigint")).alias("tenths"),
        F.count(names.pct).alias("measured"),
        F.count(F.lit(1)).alias("entities"),
        F.sum(met).alias("met"),
        F.count(names.met).alias("targeted"),
    )
    added = ["tenths", "measured", "entities", "met", "targeted"]
    year, region = F.col(names.year), F.col(names.region)
    both = sums.groupingSets([[year, region], [year]], year, region).agg(
        (F.grouping(names.region) == 1).alias("is_total"),
        *[F.sum(c).alias(c) for c in added],
    )
    mean = F.round(F.try_divide(F.col("tenths"), F.lit(10) * F.col("measured")), 1)
    return both.select(
        names.year,
        names.region,
        "is_total",
        mean.alias("mean_pct"),
        "entities",
        F.round(F.try_divide(F.lit(100) * F.col("met"), F.col("targeted")), 0).alias("met_share"),
    )
