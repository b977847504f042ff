"""Declared tables: columns, types, normal forms, keys, partition column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from yardline.names import DOMAIN, Names

# Technical columns of landed tables.
INGESTION_DATE = "ingestion_date"
INGESTED_AT = "ingested_at"
SOURCE_TABLE = "source_table"
TECHNICAL = (INGESTED_AT, SOURCE_TABLE, INGESTION_DATE)

_SPARK = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    form: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """``key`` empty means rows are measurements to be summed, not records to be unique."""

    name: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    key: tuple[str, ...] = ()
    warehouse_table: str | None = None

    @property
    def seed_file(self) -> str:
        return f"{self.name}.csv"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _SPARK[f.type]) for f in self.fields])


def group_spec(n: Names = DOMAIN, name: str = "uf", warehouse: str | None = None) -> TableSpec:
    fields = (
        Field(n.group, "int"),
        Field(n.group_code, "string", "upper"),
        Field(n.group_label, "string", "trim"),
        Field(n.region_id, "int"),
        Field(n.region, "string", "trim"),
    )
    return TableSpec(name, fields, (n.group, n.group_code), (n.group,), warehouse)


def entity_spec(
    n: Names = DOMAIN, name: str = "municipio", warehouse: str | None = None
) -> TableSpec:
    fields = (
        Field(n.entity, "bigint"),
        Field(n.entity_label, "string", "trim"),
        Field(n.group_code, "string", "upper"),
        Field(n.group, "int"),
    )
    return TableSpec(name, fields, (n.entity,), (n.entity,), warehouse)


def target_spec(
    by: tuple[Field, ...], n: Names = DOMAIN, name: str = "target", warehouse: str | None = None
) -> TableSpec:
    key = (n.year, *(f.name for f in by))
    fields = (Field(n.year, "int"), *by, Field(n.target, "double"))
    return TableSpec(name, fields, key, key, warehouse)


def measure_spec(
    n: Names = DOMAIN, name: str = "alunos", warehouse: str | None = None
) -> TableSpec:
    fields = (
        Field(n.year, "int"),
        Field(n.entity, "bigint"),
        Field(n.segment, "string", "lower"),
        Field(n.assessed, "bigint"),
        Field(n.reached, "bigint"),
        Field(n.score, "double"),
    )
    return TableSpec(name, fields, (n.year, n.entity, n.segment), (), warehouse)


# Table names and public warehouse identifiers of the six batch sources.
_DIRECTORIES = "br_bd_diretorios_brasil"
_INDICATOR = "br_inep_indicador_crianca_alfabetizada"

BATCH_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        group_spec(DOMAIN, "uf", f"{_DIRECTORIES}.uf"),
        entity_spec(DOMAIN, "municipio", f"{_DIRECTORIES}.municipio"),
        target_spec((), DOMAIN, "meta_brasil", f"{_INDICATOR}.meta_brasil"),
        target_spec(
            (Field(DOMAIN.group_code, "string", "upper"),),
            DOMAIN,
            "meta_uf",
            f"{_INDICATOR}.meta_uf",
        ),
        target_spec(
            (Field(DOMAIN.entity, "bigint"),),
            DOMAIN,
            "meta_municipio",
            f"{_INDICATOR}.meta_municipio",
        ),
        measure_spec(DOMAIN, "alunos", f"{_INDICATOR}.alunos"),
    )
}

# Table and envelope of the landed events.
EVENT_TABLE = "alunos_streaming"
#: Folder that only the landing stream writes; its log tells which of its files count.
EVENT_LANDING = "alunos_streaming_landed"
#: Folder of the stream that lands and sets apart in one step: each micro-batch replaces its own part.
EVENT_BATCHES = "alunos_streaming_batches"
EVENT_ENVELOPE = ("event_id", "event_time", "event_type")


def batch_table(name: str) -> TableSpec:
    try:
        return BATCH_TABLES[name]
    except KeyError:
        raise KeyError(f"unknown batch table {name!r}; known: {sorted(BATCH_TABLES)}") from None


def event_schema(names: Names = DOMAIN) -> T.StructType:
    """Event fields as text, so that a wrongly typed field costs only itself."""
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in (*EVENT_ENVELOPE, *names.measures)]
    )
