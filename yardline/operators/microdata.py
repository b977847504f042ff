"""Weighted aggregate of per-person rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.functions import all_present, code_label
from yardline.functions.text import NETWORKS
from yardline.names import DOMAIN, Names


def counted(rows: DataFrame) -> DataFrame:
    """Present with a filled test, and with entity and network known."""
    taken = (F.col("present") == 1) & (F.col("filled") == 1)
    return rows.filter(taken & all_present(["entity", "network"]))


def weighted_sums(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums that compose: they may be taken on any finer key first and added later.

    Decimal weights and scores give the same sums in any order.
    """
    weight = F.col("weight")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(weight).alias("w"),
        F.sum(weight * F.col("flag").cast("int")).alias("w_flag"),
        F.sum(weight * F.col("score")).alias("w_score"),
    )


def finish_microdata(
    sums: DataFrame, names: Names = DOMAIN, labels: Mapping[int, str] = NETWORKS
) -> DataFrame:
    """Weighted mean score (half-even, one decimal) and the weighted share applied to the
    number of persons (half-even), so that reached / assessed gives the official share.

    Missing terms add nothing; a group without weight has NULL results.
    """
    n = F.coalesce(F.col("n"), F.lit(0))
    w, w_flag, w_score = (F.coalesce(F.col(c).cast("double"), F.lit(0)) for c in ("w", "w_flag", "w_score"))
    return sums.select(
        F.col(names.year),
        F.col("entity").alias(names.entity),
        code_label(F.col("network"), labels).alias(names.segment),
        n.alias(names.assessed),
        F.bround(F.try_divide(n * w_flag, w), 0).cast("bigint").alias(names.reached),
        F.bround(F.try_divide(w_score, w), 1).alias(names.score),
    )


def weighted_microdata(
    rows: DataFrame, names: Names = DOMAIN, labels: Mapping[int, str] = NETWORKS
) -> DataFrame:
    sums = weighted_sums(counted(rows), [names.year, "entity", "network"])
    return finish_microdata(sums, names, labels)


def coverage(measures: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Persons assessed and number of entities per year."""
    return measures.groupBy(names.year).agg(
        F.sum(names.assessed).alias(names.assessed),
        F.countDistinct(names.entity).alias("entities"),
    )
