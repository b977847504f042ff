"""The warehouse connector: partitions, columns read, filters, writes that fail."""

import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.golden import write_seeds
from yardline import Lake
from yardline.__main__ import main
from yardline.sources import arrow_export as ax
from yardline.sources.readers import read_seed, read_source
from yardline.tables import BATCH_TABLES, batch_table

SCHEMA = "id bigint, name string, day date, flag boolean, share double, extra string"


@pytest.fixture
def table(spark, tmp_path):
    ax.register(spark)
    data = [(k, f"n{k % 7}" if k % 5 else None, dt.date(2026, 1, 1 + k % 9), k % 2 == 0, k / 8, "x" * 50) for k in range(2000)]
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    frame.write.format(ax.NAME).mode("append").option("path", str(tmp_path)).option("table", "d.t").save()
    return frame


def read(spark, path, schema=SCHEMA, **options):
    return spark.read.format(ax.NAME).schema(schema).option("path", str(path)).option("table", "d.t").options(**options).load()


def test_round_trip_and_partitions(spark, tmp_path, table):
    assert rows(read(spark, tmp_path)) == rows(table)
    assert read(spark, tmp_path).rdd.getNumPartitions() == 3
    reader = ax.ArrowReader({"path": str(tmp_path), "table": "d.t", "split_bytes": "1"}, T._parse_datatype_string(SCHEMA))
    parts = reader.partitions()
    assert len(parts) >= 3 and all(p.stop - p.start == 1 for p in parts)
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 2000
    assert spark.read.format(ax.NAME).option("path", str(tmp_path)).option("table", "d.t").load().columns == table.columns


def test_only_declared_columns_are_read(spark, tmp_path, table):
    schema = T._parse_datatype_string("share double, id bigint")
    reader = ax.ArrowReader({"path": str(tmp_path), "table": "d.t"}, schema)
    (first, *_) = reader.partitions()
    assert {tuple(b.schema.names) for b in reader.read(first)} == {("share", "id")}
    opened = []
    whole = pa.ipc.open_file

    def watched(source, options=None):
        opened.append(options)
        return whole(source, options=options)

    pa.ipc.open_file = watched
    try:
        list(reader.read(first))
    finally:
        pa.ipc.open_file = whole
    assert opened[-1].included_fields == [0, 4]


@pytest.mark.parametrize("condition", [
    "id = 7", "id > 1990", "id >= 1990 and id < 1995", "name = 'n3'", "name is null and id < 50", "name is not null", "id in (3, 5, 99999)",
    "day <= date '2026-01-02'", "flag", "not flag", "share = 1.5", "name like 'n1%'", "id = 3 or id = 4", "name <> 'n3'", "name in ('n1', null)",
])
def test_filters_agree_with_spark(spark, tmp_path, table, condition):
    found = read(spark, tmp_path).filter(condition)
    assert rows(found) == rows(table.filter(condition)) and found.count()


def test_pushed_filters_reduce_rows_in_the_task():
    schema = T._parse_datatype_string("id bigint, share double")
    reader = ax.ArrowReader({}, schema)
    given = [ds.GreaterThan(("id",), 2), ds.GreaterThan(("share",), 0.5), ds.IsNotNull(("share",)), ds.EqualTo(("s", "x"), 1), ds.Not(ds.EqualTo(("id",), 1))]
    assert list(reader.pushFilters(given)) == [given[1], given[3], given[4]]
    batch = pa.RecordBatch.from_pydict({"id": [1, 3, 4, None], "share": [1.0, None, 0.1, 2.0]})
    assert ax._kept(batch, reader.filters).to_pydict() == {"id": [4], "share": [0.1]}


def test_empty_missing_and_overwritten_tables(spark, tmp_path, table):
    (tmp_path / "none" / "d.t").mkdir(parents=True)
    assert read(spark, tmp_path / "none", "id bigint").count() == 0
    with pytest.raises(Exception, match="no column"):
        read(spark, tmp_path, "id bigint, absent string").collect()
    one = spark.createDataFrame([(1, "a", None, None, None, None)], SCHEMA)
    one.write.format(ax.NAME).mode("overwrite").option("path", str(tmp_path)).option("table", "d.t").save()
    assert rows(read(spark, tmp_path), "id", "name") == [(1, "a")]
    assert all(not f.startswith(".") for f in os.listdir(tmp_path / "d.t"))


def test_failed_write_shows_nothing(spark, tmp_path, table):
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 57, F.raise_error("lost")).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format(ax.NAME).mode("append").option("path", str(tmp_path)).option("table", "d.t").save()
    assert read(spark, tmp_path).count() == 2000


def test_sources_and_run_by_connector(spark, tmp_path):
    seeds, export = write_seeds(tmp_path / "csv"), str(tmp_path / "export")
    ax.register(spark)
    for spec in BATCH_TABLES.values():
        frame = read_seed(spark, spec, seeds).drop("_corrupt_record").withColumn("unused", F.lit("u"))
        frame.write.format(ax.NAME).mode("append").option("path", export).option("table", spec.warehouse_table).save()
    spec = batch_table("municipio")
    found = read_source(spark, spec, "", ax.NAME, {"path": export})
    assert rows(found) == rows(read_seed(spark, spec, seeds).drop("_corrupt_record")) and found.columns == [f.name for f in spec.fields]
    root = str(tmp_path / "lake")
    main(["run", "--root", root, "--ingestion-date", "2026-01-01", "--warehouse-format", ax.NAME, "--warehouse-option", f"path={export}"])
    main(["run", "--root", f"{root}2", "--ingestion-date", "2026-01-01", "--seeds-dir", seeds])
    assert rows(Lake(root).read(spark, "gold", "fato_alfabetizacao")) == rows(Lake(f"{root}2").read(spark, "gold", "fato_alfabetizacao"))
