"""Batch and streamed measurements brought to one grain."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions import all_present, percentage, weighted_mean
from yardline.names import DOMAIN, Names

SCORE_SUM = "score_sum"
SCORE_WEIGHT = "score_weight"


def unite(batch: DataFrame, stream: DataFrame | None, names: Names = DOMAIN) -> DataFrame:
    base = batch.select(*names.measures)
    return base if stream is None else base.unionByName(stream.select(*names.measures))


def grain_sums(measures: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Sums per year x entity x segment. Sums compose, so parts may be added later."""
    score, weight = F.col(names.score), F.col(names.assessed)
    return (
        measures.filter(all_present(names.grain))
        .groupBy(*names.grain)
        .agg(
            F.sum(names.assessed).alias(names.assessed),
            F.sum(names.reached).alias(names.reached),
            F.sum(score * weight).alias(SCORE_SUM),
            F.sum(F.when(score.isNotNull(), weight)).alias(SCORE_WEIGHT),
        )
    )


def add_sums(parts: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Add partial sums (as from ``grain_sums``) of the same grain."""
    columns = [names.assessed, names.reached, SCORE_SUM, SCORE_WEIGHT]
    return parts.groupBy(*names.grain).agg(*[F.sum(c).alias(c) for c in columns])


def finish(
    sums: DataFrame,
    names: Names = DOMAIN,
    null_scores: Literal["count", "exclude"] = "count",
) -> DataFrame:
    """Ratio of sums and weighted mean.

    ``null_scores="count"`` keeps the weight of rows without a score in the
    denominator of the mean; ``"exclude"`` leaves it out.
    """
    weights = F.col(names.assessed if null_scores == "count" else SCORE_WEIGHT)
    return sums.select(
        *names.grain,
        names.assessed,
        names.reached,
        weighted_mean(F.col(SCORE_SUM), weights).alias(names.score),
        percentage(F.col(names.reached), F.col(names.assessed)).alias(names.pct),
    )


def enrich(measures: DataFrame, dimension: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Attach entity, group and region attributes; unknown entities keep NULL attributes."""
    return measures.join(dimension, names.entity, "left").select(
        names.year,
        names.entity,
        names.entity_label,
        names.group_code,
        names.group,
        names.group_label,
        names.region,
        names.segment,
        names.assessed,
        names.reached,
        names.score,
        names.pct,
    )


def integrate(
    batch: DataFrame,
    stream: DataFrame | None,
    dimension: DataFrame,
    names: Names = DOMAIN,
    null_scores: Literal["count", "exclude"] = "count",
) -> DataFrame:
    sums = grain_sums(unite(batch, stream, names), names)
    return enrich(finish(sums, names, null_scores), dimension, names)


def first_per_event(events: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Optional batch dedup of redelivered events; rows without an id all stay.

    Copies are ordered by every column, so the choice does not depend on the run.
    Each row without an id is a partition of its own: no hot NULL key arises, the
    source is read once, and ``= 1`` is applied before the shuffle too.
    """
    own = F.when(F.col(event_id).isNull(), F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_last() for c in events.columns if c != event_id]
    window = Window.partitionBy(event_id, "_own").orderBy(*(order or [F.lit(1)]))
    ranked = events.withColumn("_own", own).withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "_own")
