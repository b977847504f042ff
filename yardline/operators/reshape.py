"""Wide target sheets to rows, and reconciliation of several published versions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions import all_present, parse_number
from yardline.names import DOMAIN, Names

# Fixed value: name of a yearly target column of a wide sheet.
TARGET_COLUMN = r"META_FINAL_(\d{4})"

VERSION = "version"


def wide_to_long(
    sheet: DataFrame, key: str, names: Names = DOMAIN, pattern: str = TARGET_COLUMN
) -> DataFrame:
    """One row per key and year column; text that is no positive number is left out."""
    yearly = [c for c in sheet.columns if re.fullmatch(pattern, c)]
    if not yearly:
        raise ValueError(f"no column matches {pattern}")
    text = sheet.select(key, *[F.col(c).cast("string").alias(c) for c in yearly])
    rows = text.unpivot([key], yearly, "_column", "_text").select(
        key,
        F.regexp_extract("_column", pattern, 1).cast("int").alias(names.year),
        parse_number(F.col("_text")).alias(names.target),
    )
    return rows.filter(F.col(names.target) > 0)


def stack_versions(versions: Mapping[int, DataFrame]) -> DataFrame:
    """Long sheets of several publication years in one table with a ``version`` column."""
    parts = [df.withColumn(VERSION, F.lit(v)) for v, df in sorted(versions.items())]
    return reduce(DataFrame.unionByName, parts)


def reconcile(rows: DataFrame, key: str, names: Names = DOMAIN) -> DataFrame:
    """Choose one published trajectory per unit.

    A version of a unit is complete when it has every year found anywhere in the
    input. The newest complete version is the base. Newer sheets are rounded to
    integers, so the oldest earlier version that has exactly those years and the
    same half-even rounded values takes the base's place. Units without a complete
    version are left out. A unit with two values for one year in a version is an error.

    After the first aggregation a unit has at most versions x years rows, and one
    shuffle on the unit serves all the windows.
    """
    year, version, value = F.col(names.year), F.col(VERSION), F.col(names.target)
    one_value = rows.filter(all_present([key])).groupBy(key, VERSION, names.year).agg(
        F.count(F.lit(1)).alias("_copies"), F.max(names.target).alias(names.target)
    )
    message = F.concat(
        F.lit("more than one target for unit "), F.col(key).cast("string"), F.lit(" in a version")
    )
    checked = one_value.withColumn(
        names.target,
        F.when(F.col("_copies") == 1, value).otherwise(F.raise_error(message).cast("double")),
    ).drop("_copies")
    all_years = rows.agg(F.countDistinct(names.year).alias("n")).scalar()

    of_unit = Window.partitionBy(key)
    of_version = Window.partitionBy(key, VERSION)
    of_year = Window.partitionBy(key, names.year)
    rounded = F.bround(value, 0)
    is_complete = F.count(year).over(of_version) == F.col("_all_years")
    marked = (
        checked.withColumn("_all_years", all_years)
        .repartition(key)
        .withColumn("_complete", is_complete)
        .withColumn("_base", F.max(F.when(F.col("_complete"), version)).over(of_unit))
        .filter(F.col("_complete"))
    )
    base_value = F.max(F.when(version == F.col("_base"), rounded)).over(of_year)
    compared = marked.withColumn("_same", (rounded == base_value).cast("int"))
    agrees = F.min("_same").over(of_version) == 1
    # The base agrees with itself, so the oldest agreeing complete version is the choice.
    chosen = compared.withColumn("_agrees", agrees).withColumn(
        "_chosen", F.min(F.when(F.col("_agrees"), version)).over(of_unit)
    )
    return chosen.filter(version == F.col("_chosen")).select(
        key, names.year, F.bround(value, 4).alias(names.target)
    )
