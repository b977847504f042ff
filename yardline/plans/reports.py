"""Analytic reports over the Gold tables.

Every sort ends in a unique key: the order is the same in each run, and rows that tie in
the leading column can be spread over the tasks of a range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.names import DOMAIN, Names
from yardline.operators.marts import region_summary


def year_ranking(indicator: DataFrame, year: int, n: Names = DOMAIN) -> DataFrame:
    """Entities of a year, best indicator first."""
    return (
        indicator.filter(F.col(n.year) == year)
        .orderBy(F.col(n.pct).desc_nulls_last(), n.entity)
        .select(n.entity_label, n.group_code, n.pct, n.entity_target, n.gap)
    )


def below_target(
    indicator: DataFrame, year: int, n: Names = DOMAIN, limit: int | None = None
) -> DataFrame:
    """Entities furthest below their target first; ``limit`` for a top list."""
    rows = indicator.filter((F.col(n.year) == year) & (F.col(n.gap) < 0)).orderBy(n.gap, n.entity)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(n.entity_label, n.group_code, n.pct, n.entity_target, n.gap)


def group_result(comparison: DataFrame, year: int, n: Names = DOMAIN) -> DataFrame:
    """Groups of a year against their targets, best indicator first."""
    return (
        comparison.filter(F.col(n.year) == year)
        .select(n.group_code, n.region, n.pct, n.group_target, n.met, n.gap)
        .orderBy(F.col(n.pct).desc_nulls_last(), n.group_code, n.region)
    )


def entity_series(evolution: DataFrame, label: str, n: Names = DOMAIN) -> DataFrame:
    """The yearly series of the entities with this name."""
    return (
        evolution.filter(F.col(n.entity_label) == label)
        .orderBy(n.year, n.entity)
        .select(n.year, n.entity_label, n.pct, n.previous, n.change)
    )


def segment_comparison(fact: DataFrame, year: int, n: Names = DOMAIN) -> DataFrame:
    """Segments of each entity side by side."""
    return (
        fact.filter(F.col(n.year) == year)
        .orderBy(n.entity_label, n.segment, n.entity)
        .select(n.entity_label, n.group_code, n.segment, n.pct)
    )


def feature_table(
    indicator: DataFrame, evolution: DataFrame, year: int, n: Names = DOMAIN
) -> DataFrame:
    """One row per entity with indicator, target, gap and change, for model training.

    ``evolution`` must be the full series (or the written mart): the year filter is put
    on both sides here, but it never moves below the change against the year before.
    """
    key = [n.year, n.entity]
    change = evolution.filter(F.col(n.year) == year).select(*key, n.change)
    rows = indicator.filter(F.col(n.year) == year).select(
        *key, n.region, n.pct, n.entity_target, n.gap
    )
    return rows.join(change, key, "left")


def regions(indicator: DataFrame, year: int | None = None, n: Names = DOMAIN) -> DataFrame:
    """Region summary with a total row, best region first, total last."""
    rows = indicator if year is None else indicator.filter(F.col(n.year) == year)
    return region_summary(rows, n).orderBy(
        n.year, "is_total", F.col("mean_pct").desc_nulls_last(), n.region
    )
