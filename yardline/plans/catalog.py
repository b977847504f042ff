"""Layer tables in the session catalog, so that SQL can name them ``gold.<table>``."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from yardline.names import DOMAIN, Names
from yardline.plans.schemas import layer_schema, read_layer
from yardline.sources.lake import Lake, child_names
from yardline.tables import BATCH_TABLES, EVENT_TABLE, INGESTION_DATE, event_schema

# Fixed value: folder name of a null partition.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Published tables of the layers.
LAYER_TABLES = {
    "bronze": (*BATCH_TABLES, EVENT_TABLE),
    "silver": ("uf", "municipio", "meta_brasil", "meta_uf", "meta_municipio", "alunos"),
    "gold": (
        "dim_municipio",
        "fato_alfabetizacao",
        "indicador_municipio",
        "evolucao_temporal",
        "comparacao_meta_uf",
    ),
}


def register(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    database: str | None = None,
    tables: tuple[str, ...] | None = None,
    names: Names = DOMAIN,
) -> list[str]:
    """Make an external table per dataset of a layer, or bring one that is there up to date.

    A table of unchanged columns stays as it is and only learns which partitions came and went, so
    readers beside it never miss it; new columns are added. Only a table that lost or
    retyped columns is made anew. Landed events are a table of JSON lines with their fields as text.
    """
    database = database or layer
    base = lake.path(layer, "").rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}'")
    registered = []
    for table in tables or LAYER_TABLES[layer]:
        path = lake.path(layer, table)
        children = child_names(spark, path)
        if children is None:
            continue
        name = f"`{database}`.`{table}`"
        partitions = [child for child in children if "=" in child and not child.startswith(("_", "."))]
        if table == EVENT_TABLE:
            schema = T.StructType([*event_schema(names).fields, T.StructField(INGESTION_DATE, T.DateType())])
            source, by = "json", INGESTION_DATE
        else:
            schema = _schema(spark, layer, table, path, children)
            source, by = "parquet", partitions[0].partition("=")[0] if partitions else None
        if not _kept(spark, name, path, source, schema, by):
            _make(spark, name, path, source, schema, by)
        if by is not None:
            _sync_partitions(spark, name, path, by, partitions)
        spark.catalog.refreshTable(name)
        registered.append(f"{database}.{table}")
    return registered


def _schema(spark: SparkSession, layer: str, table: str, path: str, children: list[str]) -> T.StructType:
    """What the files hold; the declared schema where there is no file to tell."""
    if any(not child.startswith(("_", ".")) for child in children):
        return spark.read.parquet(path).schema
    declared = layer_schema(spark, layer, table)
    if declared is None:
        raise FileNotFoundError(f"no file and no declared schema for {path}")
    return declared


def _columns(schema: T.StructType) -> dict[str, str]:
    return {f.name.lower(): f.dataType.simpleString() for f in schema}


def _kept(spark: SparkSession, name: str, path: str, source: str, schema: T.StructType, by: str | None) -> bool:
    """Whether the table that is there can stay; columns that are new are added to it."""
    if not spark.catalog.tableExists(name):
        return False
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    place = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().getPath()
    same = told["Provider"].lower() == source and told["Location"].rstrip("/").endswith(place)
    there, wanted = _columns(spark.read.table(name).schema), _columns(schema)
    divided = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not same or divided != ([] if by is None else [by]) or not there.items() <= wanted.items():
        return False
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name.lower() not in there]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    return True


def _make(spark: SparkSession, name: str, path: str, source: str, schema: T.StructType, by: str | None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    divided = "" if by is None else f"PARTITIONED BY (`{by}`)"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {source} {divided} LOCATION '{path}'")


def _sync_partitions(spark: SparkSession, name: str, path: str, by: str, folders: list[str]) -> None:
    """Tell the catalog of partitions that came and went, by one listing of the table's folder."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    kind = spark.read.table(name).schema[by].dataType.simpleString()

    def clause(folder: str) -> str:
        value = unquote(folder.partition("=")[2])
        told = "null" if value == NO_VALUE else f"'{value}'" if kind in ("string", "date") else value
        return f"PARTITION (`{by}` = {told})"

    gone, new = sorted(known - set(folders)), sorted(set(folders) - known)
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(clause, gone))}")
    if new:
        added = " ".join(f"{clause(folder)} LOCATION '{path}/{folder}'" for folder in new)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")


def view(spark: SparkSession, lake: Lake, layer: str, table: str, name: str | None = None) -> str:
    """A temporary view over the hive-partitioned files, without a catalog table."""
    name = name or f"{layer}_{table}"
    read_layer(spark, lake, layer, table).createOrReplaceTempView(name)
    return name
