"""Declared schemas of all layer tables, so that an empty table reads like a full one.

Silver and Gold schemas are those of the operators over empty sources: Spark analyses the plans and
runs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from yardline.operators import marts
from yardline.operators.clean import typed
from yardline.operators.integrate import integrate
from yardline.sources.lake import Lake
from yardline.tables import BATCH_TABLES, INGESTED_AT, SOURCE_TABLE, batch_table


def _empty(spark: SparkSession, name: str) -> DataFrame:
    spec = batch_table(name)
    return typed(spark.createDataFrame([], spec.schema), spec)


def _measures(spark: SparkSession) -> DataFrame:
    return integrate(_empty(spark, "alunos"), None, _dimension(spark))


def _dimension(spark: SparkSession) -> DataFrame:
    return marts.dimension(_empty(spark, "municipio"), _empty(spark, "uf"))


def _indicator(spark: SparkSession) -> DataFrame:
    return marts.indicator(marts.consolidated(_measures(spark)), _empty(spark, "meta_municipio"))


_GOLD = {
    "dim_municipio": _dimension,
    "fato_alfabetizacao": lambda s: marts.fact(_measures(s), _empty(s, "meta_municipio")),
    "indicador_municipio": _indicator,
    "evolucao_temporal": lambda s: marts.evolution(_indicator(s)),
    "comparacao_meta_uf": lambda s: marts.group_comparison(_indicator(s), _empty(s, "meta_uf")),
}


def layer_schema(spark: SparkSession, layer: str, table: str) -> T.StructType | None:
    """The schema of a published table; None for any other, whose files have to tell."""
    if layer == "bronze" and table in BATCH_TABLES:
        technical = [T.StructField(INGESTED_AT, T.TimestampType()), T.StructField(SOURCE_TABLE, T.StringType())]
        return T.StructType([*batch_table(table).schema.fields, *technical])
    if layer == "silver" and table in BATCH_TABLES:
        return (_measures(spark) if table == "alunos" else _empty(spark, table)).schema
    if layer == "gold" and table in _GOLD:
        return _GOLD[table](spark).schema
    return None


def read_layer(spark: SparkSession, lake: Lake, layer: str, table: str) -> DataFrame:
    return lake.read(spark, layer, table, layer_schema(spark, layer, table))
