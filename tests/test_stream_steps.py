"""Landing and setting apart in one step, stream metrics, registered tables that stay in place."""

import threading
import time

import pytest

from tests.conftest import rows
from tests.golden import EVENT, write_seeds
from tests.test_streaming import drop, event, finished
from yardline import Lake
from yardline.__main__ import main
from yardline.operators import marts
from yardline.operators.events import valid_events
from yardline.plans import catalog
from yardline.plans.metrics import StreamMetrics
from yardline.plans.pipeline import Run, run_stages
from yardline.sources.lake import write_changed, write_parquet, write_snapshot
from yardline.streaming import events as ev
from yardline.streaming import totals


def both(spark, root):
    return [rows(spark.read.text(f"{root}/{side}"), "value") for side in ("landed", "apart")]


def test_crash_between_the_two_writes(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "in", str(tmp_path / "out")
    drop(source, "a.json", [event(1), "{broken", "", event(2)])
    whole, calls = ev.write_batch, []

    def failing(batch, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost between the writes")
        whole(batch, path)

    def land():
        lines = ev.read_lines(spark, str(source))
        return ev.land_apart(lines, f"{root}/landed", f"{root}/apart", f"{root}/mark", "2026-01-05", trigger=ev.ALL_AVAILABLE)

    monkeypatch.setattr(ev, "write_batch", failing)
    with pytest.raises(Exception, match="lost between"):
        land().awaitTermination()
    assert len(calls) == 2 and spark.read.text(f"{root}/landed").count() == 2
    monkeypatch.setattr(ev, "write_batch", whole)
    finished(land())
    drop(source, "b.json", ["[1", event(3)])
    finished(land())
    landed, apart = both(spark, root)
    assert landed == sorted([(event(k),) for k in (1, 2, 3)]) and apart == [("[1",), ("{broken",)]
    assert {str(r[0]) for r in spark.read.text(f"{root}/apart").select("ingestion_date").collect()} == {"2026-01-05"}


def test_landing_apart_feeds_the_run(spark, tmp_path):
    root, seeds = str(tmp_path / "lake"), write_seeds(tmp_path / "csv")
    drop(tmp_path / "events", "a.json", [EVENT, "broken"])
    main(["land", "--root", root, "--events", str(tmp_path / "events"), "--ingestion-date", "2026-01-01", "--once", "--apart"])
    main(["run", "--root", root, "--seeds-dir", seeds, "--ingestion-date", "2026-01-01"])
    fact = Lake(root).read(spark, "gold", "fato_alfabetizacao")
    assert rows(fact.filter("ano = 2024 and sigla_uf = 'SP'"), "qtd_avaliados") == [(1200,)]
    told = spark.read.parquet(f"{root}/run_metrics").filter("stage = 'landing'")
    assert {"InputRows", "StageSuccess", "BatchDurationMilliseconds"} <= {r["metric"] for r in told.collect()}


def test_stream_metrics_tell_counts_lateness_and_failure(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "metrics")
    drop(source, "a.json", [event(1, 5, 9), event(2, 9, 9)])
    measures = ev.measurements(valid_events(ev.read_lines(spark, str(source))))
    with StreamMetrics(spark, path, "totals", rows_at_once=3):
        finished(totals.keep_totals(measures, str(tmp_path / "t"), str(tmp_path / "m"), trigger=ev.ALL_AVAILABLE))
        timed = valid_events(ev.read_lines(spark, str(source)))
        kept = ev.drop_redelivered(timed, "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "p"))
        finished(kept.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())

        def fail(batch, batch_id):
            raise RuntimeError("sink is gone")

        bad = ev.read_lines(spark, str(source)).writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "f"))
        with pytest.raises(Exception, match="sink is gone"):
            bad.trigger(availableNow=True).start().awaitTermination()
    saved = spark.read.parquet(path)
    assert set(saved.select("stage").distinct().toPandas()["stage"]) == {"totals"}
    found = {}
    for r in saved.collect():
        found.setdefault(r["metric"], []).append(r["value"])
    assert sum(found["event_invariant.reached_above_assessed"]) == 1 and sum(found["event_invariant.rows"]) == 2
    assert len(found["StageSuccess"]) == 2 and found["StageFailure"] == [1.0]
    assert "RowsDroppedByWatermark" in found and "WatermarkLagSeconds" in found and "StateRows" in found


# --- registered tables --------------------------------------------------------------------


def test_registered_tables_learn_partitions_in_place(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    path = lake.path("bronze", "uf")
    rows_of = lambda k: spark.createDataFrame([(k, f"S{k}")], "id_uf int, sigla_uf string")
    write_snapshot(rows_of(1), path, "2026-01-01")
    catalog.register(spark, lake, "bronze", "in_place", ("uf",))
    created = spark.sql("DESCRIBE TABLE EXTENDED in_place.uf").filter("col_name = 'Created Time'").collect()
    stop, failures = threading.Event(), []

    def reading():
        while not stop.is_set():
            try:
                spark.sql("select count(*) from in_place.uf").collect()
            except Exception as error:
                failures.append(error)
            time.sleep(0.01)

    reader = threading.Thread(target=reading)
    reader.start()
    listed = []
    whole = catalog._sync_partitions

    def spied(session, name, place, by, folders):
        before = spark.sql(f"SHOW PARTITIONS {name}").count()
        whole(session, name, place, by, folders)
        listed.append(spark.sql(f"SHOW PARTITIONS {name}").count() - before)

    catalog._sync_partitions = spied
    try:
        for day in (2, 3):
            write_snapshot(rows_of(day), path, f"2026-01-0{day}")
            catalog.register(spark, lake, "bronze", "in_place", ("uf",))
    finally:
        catalog._sync_partitions = whole
        stop.set()
        reader.join()
    assert not failures and listed == [1, 1]
    assert rows(spark.table("in_place.uf"), "id_uf") == [(1,), (2,), (3,)]
    assert spark.sql("DESCRIBE TABLE EXTENDED in_place.uf").filter("col_name = 'Created Time'").collect() == created


def test_gone_partitions_new_columns_and_new_types(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    path = lake.path("gold", "indicador_municipio")
    table = spark.createDataFrame([(2023, 1, None), (2024, 2, 7.5), (None, 3, 1.0)], "ano int, k int, v double")
    write_changed(table, path, "ano")

    def registered():
        catalog.register(spark, lake, "gold", "changing", ("indicador_municipio",))
        return spark.table("changing.indicador_municipio")

    assert rows(registered(), "ano", "k") == [(None, 3), (2023, 1), (2024, 2)]
    write_changed(table.filter("ano = 2024"), path, "ano")
    assert rows(registered(), "ano", "k") == [(2024, 2)]
    write_changed(table.selectExpr("ano", "k", "v", "'x' as more").filter("ano = 2024"), path, "ano")
    assert rows(registered(), "more") == [("x",)]
    write_changed(table.selectExpr("ano", "cast(k as string) as k", "v").filter("ano = 2024"), path, "ano")
    assert dict(registered().dtypes)["k"] == "string" and rows(registered(), "k") == [("2",)]


def test_tables_of_any_columns_register(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_parquet(spark.createDataFrame([(1, "a")], "entity_id bigint, extra string"), lake.path("bronze", "municipio"))
    catalog.register(spark, lake, "bronze", "other_names", ("municipio",))
    assert rows(spark.table("other_names.municipio")) == [(1, "a")]


def test_a_series_goes_on_when_the_label_changes(spark):
    total = spark.createDataFrame(
        [(2023, 1, "old", "S", "R", 50.0), (2024, 1, "new", "S", "R", 60.0)],
        "ano int, id_municipio bigint, nome_municipio string, sigla_uf string, nome_regiao string, indicador_pct double",
    )
    assert rows(marts.evolution(total), "ano", "variacao_pp") == [(2023, None), (2024, 10.0)]


def test_unchanged_years_keep_their_files_from_run_to_run(spark, tmp_path):
    lake, seeds = Lake(str(tmp_path / "lake")), write_seeds(tmp_path / "csv")
    for date in ("2026-01-01", "2026-01-02"):
        run = Run(spark, lake, date, seeds)
        run_stages(run)
    assert run.metrics.value("PartitionsRewritten", table="alunos") == 0
    assert run.metrics.value("PartitionsKept", table="fato_alfabetizacao") > 0
