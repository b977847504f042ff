"""Preparation of the six batch sources from the published territory, sheets and microdata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.names import DOMAIN as N
from yardline.names import Names
from yardline.operators.microdata import weighted_microdata
from yardline.operators.reshape import reconcile, stack_versions, wide_to_long
from yardline.session import scratch_dir
from yardline.sources.lake import write_csv
from yardline.sources.readers import (
    read_entity_sheet,
    read_group_sheet,
    read_microdata,
    read_municipalities,
    read_states,
)

NATIONAL = "BR"


@dataclass(frozen=True)
class Inputs:
    """Landed files. Sheets and microdata are given per publication or assessment year."""

    states: str
    municipalities: str
    entity_sheets: Mapping[int, str]
    group_sheets: Mapping[int, str]
    microdata: Mapping[int, str]


def entity_targets(spark: SparkSession, sheets: Mapping[int, str]) -> DataFrame:
    versions = {
        year: wide_to_long(read_entity_sheet(spark, path), N.entity)
        for year, path in sheets.items()
    }
    return reconcile(stack_versions(versions), N.entity)


def group_targets(spark: SparkSession, sheets: Mapping[int, str]) -> DataFrame:
    """State and national trajectories together; the national one has code ``BR``."""
    versions = {
        year: wide_to_long(read_group_sheet(spark, path), N.group_code)
        for year, path in sheets.items()
    }
    return reconcile(stack_versions(versions), N.group_code)


def split_national(targets: DataFrame, names: Names = N) -> tuple[DataFrame, DataFrame]:
    """The national trajectory, and those of the states.

    Both are read from one written table, divided by side, so that whatever made ``targets`` runs once and each side opens
    its own folder.
    """
    path = scratch_dir(targets.sparkSession, "group-targets")
    targets.withColumn("side", F.when(F.col(names.group_code) == NATIONAL, "national").otherwise("state")).write.partitionBy("side").parquet(path)
    written = targets.sparkSession.read.schema(T.StructType([*targets.schema.fields, T.StructField("side", T.StringType())])).parquet(path)
    return tuple(written.filter(F.col("side") == side).drop("side") for side in ("national", "state"))


def prepare(spark: SparkSession, inputs: Inputs, out: str) -> None:
    """Write the six sources as CSV folders that the batch ingest reads."""
    out = out.rstrip("/")
    states = read_states(spark, inputs.states)
    municipalities = read_municipalities(spark, inputs.municipalities, states)
    state_columns = [N.group, N.group_code, N.group_label, N.region_id, N.region]
    write_csv(states, f"{out}/uf.csv", state_columns, [N.group])
    entity_columns = [N.entity, N.entity_label, N.group_code, N.group]
    write_csv(municipalities, f"{out}/municipio.csv", entity_columns, [N.entity])

    national, by_group = split_national(group_targets(spark, inputs.group_sheets))
    write_csv(national, f"{out}/meta_brasil.csv", [N.year, N.target], [N.year])
    write_csv(
        by_group,
        f"{out}/meta_uf.csv",
        [N.year, N.group_code, N.target],
        [N.group_code, N.year],
    )
    write_csv(
        entity_targets(spark, inputs.entity_sheets),
        f"{out}/meta_municipio.csv",
        [N.year, N.entity, N.target],
        [N.entity, N.year],
    )
    measures = weighted_microdata(read_microdata(spark, inputs.microdata))
    write_csv(measures, f"{out}/alunos.csv", N.measures, N.grain)
