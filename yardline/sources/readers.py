"""Readers for the published inputs. Schemas are declared; nothing is inferred."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.functions import (
    all_present,
    blank_to_null,
    id_prefix,
    plain_number,
    strip_marker,
    whole_number,
)
from yardline.names import DOMAIN, Names
from yardline.operators.events import CORRUPT, parse_lines
from yardline.sources import arrow_export
from yardline.sources.heads import find_heads, first_lines, plain_cells, quoted_cells
from yardline.sources.lake import child_names
from yardline.tables import INGESTION_DATE, TableSpec

#: A URI's scheme may be followed by one slash or several.
_SLASHES = ":/+"
_DATED = f"{INGESTION_DATE}="


def read_seed(spark: SparkSession, spec: TableSpec, folder: str) -> DataFrame:
    """One batch source as CSV with header.

    The header is checked against the declared columns, since CSV schemas are
    positional. A line that does not fit is kept in ``_corrupt_record``.
    """
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(f"{folder.rstrip('/')}/{spec.seed_file}")
    )


def read_warehouse(
    spark: SparkSession,
    spec: TableSpec,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One batch source from a warehouse: a catalog table, or any connector by format.

    The connector is given the table as option ``table`` and reads on executors. The export source
    is told the declared columns, so that it reads no other.
    """
    if fmt is None:
        table = spark.read.table(spec.warehouse_table)
    else:
        reader = spark.read.format(fmt).option("table", spec.warehouse_table)
        if fmt == arrow_export.NAME:
            arrow_export.register(spark)
            reader = reader.schema(spec.schema)
        table = reader.options(**(options or {})).load()
    return table.select(*[f.name for f in spec.fields])


def read_source(
    spark: SparkSession,
    spec: TableSpec,
    seeds: str,
    warehouse_format: str | None = None,
    warehouse_options: Mapping[str, str] | None = None,
    use_warehouse: bool = False,
) -> DataFrame:
    if use_warehouse or warehouse_format:
        return read_warehouse(spark, spec, warehouse_format, warehouse_options)
    return read_seed(spark, spec, seeds)


def read_event_lines(
    spark: SparkSession,
    path: str,
    landed: str | Collection[str] | None = None,
    names: Names = DOMAIN,
    dates: Collection[str] | None = None,
) -> DataFrame:
    """Events of all dates, fields as text, unparsable lines in ``_corrupt_record``.

    Every file below ``path`` counts, whoever wrote it and whatever its name. A landing stream
    has a folder of its own, ``landed``, in which its log decides: leftovers of a failed
    attempt are not in it. A missing folder is an empty stream; any other failure is raised.
    There may be several such folders. With ``dates`` only folders of these dates are opened.
    """
    parts = []
    children = child_names(spark, path) or []
    dated = [c for c in children if c.startswith(_DATED)]
    wanted = dated if dates is None else [c for c in dated if c[len(_DATED) :] in dates]
    if wanted:
        # By date folders, since a log that a stream has left in ``path`` would hide other files.
        folders = [f"{path}/{_DATED}*"] if dates is None else [f"{path}/{c}" for c in wanted]
        parts.append(spark.read.option("basePath", path).text(folders).select("value", INGESTION_DATE))
    elif children and not dated and dates is None:
        parts.append(spark.read.text(path))
    for folder in [landed] if isinstance(landed, str) else landed or []:
        if child_names(spark, folder) is None:
            continue
        stream = spark.read.text(folder)
        stream = stream.select("value", *[c for c in stream.columns if c == INGESTION_DATE])
        if dates is None:
            parts.append(stream)
        elif INGESTION_DATE in stream.columns:
            parts.append(stream.filter(F.col(INGESTION_DATE).cast("string").isin(list(dates))))
    if not parts:
        return parse_lines(spark.createDataFrame([], "value string"), names)
    lines = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return parse_lines(lines, names)


def read_states(
    spark: SparkSession, path: str, names: Names = DOMAIN, multi_line: bool = True
) -> DataFrame:
    """Nested territory JSON of states, flattened.

    The published file is one JSON array, which needs ``multi_line``; JSON lines do not,
    and are split over tasks.
    """
    nested = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("sigla", T.StringType()),
            T.StructField("nome", T.StringType()),
            T.StructField(
                "regiao",
                T.StructType(
                    [
                        T.StructField("id", T.IntegerType()),
                        T.StructField("nome", T.StringType()),
                    ]
                ),
            ),
        ]
    )
    raw = spark.read.schema(nested).option("multiLine", multi_line).json(path)
    return raw.select(
        F.col("id").alias(names.group),
        F.col("sigla").alias(names.group_code),
        F.col("nome").alias(names.group_label),
        F.col("regiao.id").alias(names.region_id),
        F.col("regiao.nome").alias(names.region),
    )


def read_municipalities(
    spark: SparkSession,
    path: str,
    states: DataFrame,
    names: Names = DOMAIN,
    multi_line: bool = True,
) -> DataFrame:
    """Territory JSON of municipalities with the state found by the id prefix."""
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("nome", T.StringType())]
    )
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    rows = raw.select(
        F.col("id").alias(names.entity), F.col("nome").alias(names.entity_label)
    )
    return with_parent(rows, states, names)


def with_parent(
    rows: DataFrame, parents: DataFrame, names: Names = DOMAIN, digits: int = 2
) -> DataFrame:
    """Add the parent read from the leading digits of the id; an unknown parent is an error."""
    keyed = rows.withColumn(names.group, id_prefix(F.col(names.entity), digits))
    known = parents.select(names.group, names.group_code, names.region)
    message = F.concat(F.lit("no parent for id "), F.col(names.entity).cast("string"))
    return (
        keyed.join(known.withColumn("_found", F.lit(True)), names.group, "left")
        .withColumn(
            names.group_code,
            F.when(F.col("_found"), F.col(names.group_code)).otherwise(
                F.raise_error(message).cast("string")
            ),
        )
        .select(
            names.entity, names.entity_label, names.group_code, names.group, names.region
        )
    )


def read_text_table(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """A delimited file with header, every column as text, to be picked by name.

    All files of a folder must have the first one's header; another one is an error. Files
    that differ are read by ``read_by_header``.
    """
    options = {"header": True, "sep": sep, "encoding": encoding}
    columns = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)


def read_by_header(lines: DataFrame, columns: Iterable[str], sep: str) -> DataFrame:
    """Named columns, as text, of delimited lines (``value``) whose files differ in column order.

    A file's header is the first line of its head that holds all the names; what stands above it is no data.
    Headers are a row per file, whose size decides how they are joined; a line of a file without one is an error.
    Other columns of ``lines`` stay. For plain fields: a quoted field must not hold ``sep``.
    """
    columns = list(columns)
    spark = lines.sparkSession
    heads = find_heads(spark, lines.inputFiles(), columns, plain_cells(sep))
    headers = spark.createDataFrame(
        [(re.sub(_SLASHES, ":/", uri), list(h.cells), list(h.lines)) for uri, h in heads.items()], "_file string, _header array<string>, _lines array<string>"
    )
    fields = F.transform(F.split("value", f"\\Q{sep}\\E"), lambda x: F.trim(x, F.lit(' "\r\ufeff')))
    other = [c for c in lines.columns if c != "value"]
    place = F.regexp_replace("_metadata.file_path", _SLASHES, ":/").alias("_file")
    named = lines.select(*other, place, "value").join(headers, "_file", "left")
    rows = named.filter(F.coalesce(~F.array_contains("_lines", F.rtrim("value", F.lit("\r"))), F.lit(True)))
    missing = F.raise_error(F.concat(F.lit("no header in "), F.col("_file"))).cast("string")
    return rows.withColumn("_fields", fields).select(
        *other,
        *[
            F.when(F.col("_header").isNull(), missing)
            .otherwise(F.get("_fields", F.array_position("_header", c).cast("int") - 1))
            .alias(c)
            for c in columns
        ],
    )


def read_sheet(spark: SparkSession, path: str, columns: Collection[str], sep: str = ",") -> DataFrame:
    """A sheet exported as delimited text, every column as text.

    The header is the first line that names the given columns, within the head of each file; titles may
    stand above it. All files of a folder must have the first one's header.
    """
    lines = spark.read.text(path)
    files = sorted(lines.inputFiles())
    heads = find_heads(spark, files, columns, quoted_cells(sep))
    found = [heads[uri] for uri in files if uri in heads]
    if not found:
        raise ValueError(f"no header with {sorted(columns)} in {path}")
    for uri in files:
        if uri in heads and heads[uri].cells != found[0].cells:
            raise ValueError(f"CSV header does not conform to that of the first file: {uri}")
        if uri not in heads and any(line.strip() for line in first_lines(spark, uri)):
            raise ValueError(f"CSV header does not conform to that of the first file, none is found: {uri}")
    if not any(head.above for head in found):
        return read_text_table(spark, path, sep)
    names = [cell or f"_c{k}" for k, cell in enumerate(found[0].cells)]
    names = [name if names.count(name) == 1 else f"{name}{k}" for k, name in enumerate(names)]
    # A few lines per file: titles and header, wherever their file's splits begin.
    titles = sorted({line for head in found for line in head.lines})
    told = F.rtrim(F.col("value"), F.lit("\r"))
    rows = lines.filter((F.length(F.trim("value")) > 0) & ~told.isin(titles))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    return rows.select(F.from_csv("value", schema, {"sep": sep}).alias("row")).select("row.*")


def read_entity_sheet(spark: SparkSession, path: str, names: Names = DOMAIN) -> DataFrame:
    """Wide target sheet by municipality, exported as CSV."""
    sheet = read_sheet(spark, path, ["CO_MUNICIPIO"])
    key = whole_number(F.col("CO_MUNICIPIO"))
    return sheet.withColumn(names.entity, key).filter(all_present([names.entity]))


def read_group_sheet(spark: SparkSession, path: str, names: Names = DOMAIN) -> DataFrame:
    """Wide target sheet by state; the national row has no state code and becomes ``BR``."""
    sheet = read_sheet(spark, path, ["NOME_UF", "SIGLA_UF"])
    code = strip_marker(blank_to_null(F.col("SIGLA_UF")), "*", default="BR")
    named = sheet.filter(blank_to_null(F.col("NOME_UF")).isNotNull())
    return named.withColumn(names.group_code, code)


# Microdata columns and the role each plays in the aggregate.
MICRODATA_COLUMNS = {
    "TP_DEPENDENCIA": "network",
    "CO_MUNICIPIO": "entity",
    "IN_PRESENCA_LP": "present",
    "IN_PREENCHIMENTO_LP": "filled",
    "VL_PESO_ALUNO_LP": "weight",
    "VL_PROFICIENCIA_LP": "score",
    "IN_ALFABETIZADO": "flag",
}
# Weights and scores as decimals: their sums do not depend on the order of addition.
_MICRODATA_TYPES = {"weight": "decimal(18,8)", "score": "decimal(18,8)"}
_WHOLE = ("network", "entity")


def microdata_columns(lines: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Typed microdata columns of raw lines that carry their year."""
    raw = read_by_header(lines, MICRODATA_COLUMNS, ";")
    columns = []
    for source, role in MICRODATA_COLUMNS.items():
        text = F.btrim(F.col(source), F.lit(" "))
        if role in _WHOLE:
            value = whole_number(text, "int" if role == "network" else "bigint")
        elif role in _MICRODATA_TYPES:
            value = F.when(plain_number(text).isNotNull(), text.try_cast(_MICRODATA_TYPES[role]))
        else:
            value = plain_number(text)
        columns.append(value.alias(role))
    return raw.select(names.year, *columns)


def read_microdata(
    spark: SparkSession, files: Mapping[int, str] | str, names: Names = DOMAIN
) -> DataFrame:
    """Per-student rows of several years; seven columns, by each file's header.

    ``files`` is a folder partitioned by year, which is one scan, or ``{year: path}``.
    """
    if isinstance(files, str):
        folder = spark.read.text(files)
        lines = folder.select(F.col(names.year).cast("int"), "value", "_metadata")
    else:
        lines = reduce(
            DataFrame.unionByName,
            [
                spark.read.text(path).select(F.lit(year).alias(names.year), "value", "_metadata")
                for year, path in sorted(files.items())
            ],
        )
    return microdata_columns(lines.filter(F.length(F.trim("value")) > 0), names)
