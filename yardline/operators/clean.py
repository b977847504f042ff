"""Typing, key normalisation, null handling and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions import normalise, to_type
from yardline.tables import INGESTED_AT, TECHNICAL, TableSpec


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


def typed(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns only, typed and in normal form; declared order."""
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in spec.required if c not in present]
    if missing:
        raise ValueError(f"{spec.name}: required column(s) absent: {missing}")
    columns = [
        normalise(to_type(F.col(f.name), present[f.name], f.type), f.form).alias(f.name)
        for f in spec.fields
        if f.name in present
    ]
    return df.select(*columns, *[c for c in keep if c in present])


def is_rejected(spec: TableSpec) -> Column:
    """True for a typed row that lacks a required value."""
    rejected = F.lit(False)
    for name in spec.required:
        rejected = rejected | F.col(name).isNull()
    return rejected


def newest_per_key(
    df: DataFrame, key: Sequence[str], newest_by: Sequence[str] = (), drop: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the newest, and among equals the first by all other columns.

    ``row_number() = 1`` is applied before the shuffle as well (Spark plans a
    partial group limit), so a key with very many copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in key and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in newest_by]
    order += [F.col(c).asc_nulls_last() for c in rest]
    window = Window.partitionBy(*key).orderBy(*(order or [F.lit(1)]))
    ranked = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1)
    return ranked.drop("_rank", *drop)


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    rows = typed(df, spec, keep=[INGESTED_AT]).filter(~is_rejected(spec))
    newest_by = [INGESTED_AT] if INGESTED_AT in rows.columns else []
    if not spec.key:
        return rows.drop(*newest_by)
    return newest_per_key(rows, spec.key, newest_by, drop=newest_by)
