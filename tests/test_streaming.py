import base64
import json

from tests.conftest import rows
from tests.golden import EVENT
from yardline.operators.integrate import finish, grain_sums
from yardline.plans.metrics import progress_rows
from yardline.sources.lake import write_json_lines
from yardline.operators.events import parse_lines, valid_events
from yardline.sources.readers import CORRUPT, read_event_lines
from yardline.streaming import events as ev
from yardline.streaming import totals


def event(n, assessed=10, reached=5, **other):
    record = {**json.loads(EVENT), "event_id": f"e{n}", "qtd_avaliados": assessed, "qtd_alfabetizados": reached}
    return json.dumps({**record, **other})


def drop(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def finished(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_landing_is_once_only_across_restarts(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    drop(source, "a.json", [event(1), "", event(2), "{broken"])

    def land():
        lines = ev.read_lines(spark, str(source), max_files=1)
        return finished(ev.land(lines, out, mark, "2026-01-05", ev.ALL_AVAILABLE))

    land()
    land()
    landed = read_event_lines(spark, out)
    assert landed.filter(landed[CORRUPT].isNull()).count() == 2
    assert [r[CORRUPT] for r in landed.filter(landed[CORRUPT].isNotNull()).collect()] == ["{broken"]
    drop(source, "b.json", [event(3)])
    land()
    landed = read_event_lines(spark, out)
    assert landed.count() == 4
    assert [str(r[0]) for r in landed.select("ingestion_date").distinct().collect()] == ["2026-01-05"]


def test_landing_blank_lines_only_writes_no_event(spark, tmp_path):
    drop(tmp_path / "in", "a.json", ["", "  "])
    lines = ev.read_lines(spark, str(tmp_path / "in"))
    finished(ev.land(lines, str(tmp_path / "out"), str(tmp_path / "mark"), trigger=ev.ALL_AVAILABLE))
    assert list((tmp_path / "out").glob("ingestion_date=*")) == []


def test_landing_defaults_to_the_date_of_the_batch(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [event(1)])
    lines = ev.read_lines(spark, str(tmp_path / "in"))
    finished(ev.land(lines, str(tmp_path / "out"), str(tmp_path / "mark"), trigger=ev.ALL_AVAILABLE))
    today = str(spark.sql("select current_date()").first()[0])
    assert [p.name for p in (tmp_path / "out").glob("ingestion_date=*")] == [f"ingestion_date={today}"]


def test_encoded_payloads_are_decoded_to_lines(spark):
    pretty = json.dumps(json.loads(event(2)), indent=1)
    data = [base64.b64encode(t.encode()).decode() for t in (event(1), pretty)] + ["%%%"]
    records = spark.createDataFrame([(d,) for d in data], "data string")
    lines = ev.decoded_lines(records)
    assert not any("\n" in r.value for r in lines.collect())
    assert rows(valid_events(lines), "event_id") == [("e1",), ("e2",)]
    parsed = parse_lines(lines)
    assert [r[CORRUPT] for r in parsed.filter(parsed[CORRUPT].isNotNull()).collect()] == ["%%%"]


def test_wrongly_typed_field_costs_only_itself(spark):
    lines = spark.createDataFrame([(event(1, ano="soon"),), (event(2, ano="2024"),)], "value string")
    assert rows(ev.measurements(valid_events(lines)), "ano") == [(None,), (2024,)]


def test_line_is_parsed_once(spark):
    lines = spark.createDataFrame([(event(1),)], "value string")
    sums = grain_sums(ev.measurements(valid_events(lines)))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_quarantine_keeps_broken_lines(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [event(1), "{broken", "", "[1, 2"])
    lines = ev.read_lines(spark, str(tmp_path / "in"))
    finished(ev.quarantine(lines, str(tmp_path / "out"), str(tmp_path / "mark"), trigger=ev.ALL_AVAILABLE))
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("[1, 2",), ("{broken",)]


def test_running_sums_with_restart_snapshot_and_invariant(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def keep():
        lines = ev.read_lines(spark, str(source), max_files=1)
        measures = ev.measurements(valid_events(lines))
        return finished(totals.keep_totals(measures, out, mark, trigger=ev.ALL_AVAILABLE))

    drop(source, "a.json", [event(1, 5, 2), event(2, 9, 9, id_municipio=7)])
    keep()
    drop(source, "b.json", [event(3, 7, 8), "{broken"])
    query = keep()
    observed = [p["observed"]["event_invariant"] for p in progress_rows(query) if p["observed"]]
    assert sum(o["reached_above_assessed"] for o in observed) == 1

    def sums():
        return rows(totals.read_totals(spark, out), "id_municipio", "qtd_avaliados", "qtd_alfabetizados")

    assert sums() == [(7, 9, 9), (3550308, 12, 10)]
    upto = totals.snapshot_totals(spark, out)
    assert sums() == [(7, 9, 9), (3550308, 12, 10)]
    drop(source, "c.json", [event(4, 1, 1)])
    keep()
    assert sums() == [(7, 9, 9), (3550308, 13, 11)]
    assert totals.snapshot_totals(spark, out) > upto
    assert sums() == [(7, 9, 9), (3550308, 13, 11)]


def test_stream_sums_added_to_batch_equal_one_aggregation(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [event(n, n, n // 2, media_proficiencia=700.0 + n) for n in range(1, 9)])
    lines = spark.read.text(str(tmp_path / "in"))
    measures = ev.measurements(valid_events(lines))
    stream = ev.measurements(valid_events(ev.read_lines(spark, str(tmp_path / "in"))))
    finished(totals.keep_totals(stream, str(tmp_path / "out"), str(tmp_path / "mark"), trigger=ev.ALL_AVAILABLE))
    added = totals.add_stream(grain_sums(measures), totals.read_totals(spark, str(tmp_path / "out")))
    assert rows(finish(added)) == rows(finish(grain_sums(measures.unionByName(measures))))


def test_redelivered_events_are_dropped_in_the_stream(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [event(1), event(1), event(None, event_id=None), event(None, event_id=None)])

    def once():
        events = valid_events(ev.read_lines(spark, str(tmp_path / "in"), max_files=1))
        return finished(
            ev.drop_redelivered(events, "1 day")
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "mark"))
            .trigger(availableNow=True)
            .start()
        )

    once()
    drop(tmp_path / "in", "b.json", [event(1), event(2)])
    once()
    found = rows(spark.read.parquet(str(tmp_path / "out")), "event_id")
    assert found == [(None,), (None,), ("e1",), ("e2",)]


def test_event_files_are_appended_by_date(spark, tmp_path):
    lines = spark.createDataFrame([(event(1),)], "value string")
    events = valid_events(lines)
    for date in ("2026-01-01", "2026-01-02", "2026-01-02"):
        write_json_lines(events, str(tmp_path / "events"), date)
    back = read_event_lines(spark, str(tmp_path / "events"))
    assert back.count() == 3
    assert back.groupBy("ingestion_date").count().count() == 2


def test_files_of_other_writers_count_before_and_after_a_stream_starts(spark, tmp_path):
    given, landed = tmp_path / "events", str(tmp_path / "landed")
    for name, n in (("a.txt", 1), ("b.jsonl", 2), ("c", 3)):
        drop(given / "ingestion_date=2026-01-04", name, [event(n)])

    def found():
        return [r[0] for r in rows(read_event_lines(spark, str(given), landed), "event_id")]

    assert found() == ["e1", "e2", "e3"]
    drop(tmp_path / "in", "a.json", [event(4)])
    lines = ev.read_lines(spark, str(tmp_path / "in"))
    finished(ev.land(lines, landed, str(tmp_path / "mark"), "2026-01-05", ev.ALL_AVAILABLE))
    assert found() == ["e1", "e2", "e3", "e4"]
    (tmp_path / "landed" / "ingestion_date=2026-01-05" / "part-left-over.txt").write_text(event(5))
    drop(given / "ingestion_date=2026-01-06", "d.txt", [event(6)])
    assert found() == ["e1", "e2", "e3", "e4", "e6"]


def test_files_beside_the_log_of_an_older_stream_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    drop(tmp_path / "in", "a.json", [event(1)])
    finished(ev.land(ev.read_lines(spark, str(tmp_path / "in")), out, str(tmp_path / "mark"), "2026-01-05", ev.ALL_AVAILABLE))
    drop(tmp_path / "out" / "ingestion_date=2026-01-05", "b.txt", [event(2)])
    assert rows(read_event_lines(spark, out), "event_id") == [("e1",), ("e2",)]


def test_an_unfinished_snapshot_is_not_read(spark, tmp_path):
    out = str(tmp_path / "out")
    drop(tmp_path / "in", "a.json", [event(1, 5, 2)])
    stream = ev.measurements(valid_events(ev.read_lines(spark, str(tmp_path / "in"))))
    finished(totals.keep_totals(stream, out, str(tmp_path / "mark"), trigger=ev.ALL_AVAILABLE))
    want = rows(totals.read_totals(spark, out))
    (tmp_path / "out" / "snapshots" / "upto=99" / "_temporary").mkdir(parents=True)
    (tmp_path / "out" / "batches" / "batch_id=98" / "_temporary").mkdir(parents=True)
    assert rows(totals.read_totals(spark, out)) == want and len(want) == 1
    assert totals.snapshot_totals(spark, out) == 0
    made = (tmp_path / "out" / "snapshots" / "upto=0" / "_SUCCESS").stat().st_mtime_ns
    assert totals.snapshot_totals(spark, out) == 0
    assert (tmp_path / "out" / "snapshots" / "upto=0" / "_SUCCESS").stat().st_mtime_ns == made
    assert rows(totals.read_totals(spark, out)) == want


def test_late_events_without_id_stay(spark, tmp_path):
    def at(day, **more):
        return event(None, event_time=f"2026-01-{day:02d}T00:00:00+00:00", **more)

    def once():
        events = valid_events(ev.read_lines(spark, str(tmp_path / "in"), max_files=1))
        query = (
            ev.drop_redelivered(events, "1 hour").writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark"))
            .trigger(availableNow=True).start()
        )
        return finished(query)

    drop(tmp_path / "in", "a.json", [at(20, event_id="new")])
    once()
    drop(tmp_path / "in", "b.json", [at(21, event_id="newer")])
    once()
    drop(tmp_path / "in", "c.json", [at(1, event_id="late"), at(1, event_id=None), at(1, event_id=None)])
    query = once()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == [(None,), (None,), ("new",), ("newer",)]
    progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    dropped = [s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_missing_folder_and_no_batches_are_empty(spark, tmp_path):
    assert read_event_lines(spark, str(tmp_path / "none")).count() == 0
    empty = totals.read_totals(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and "batch_id" not in empty.columns
    assert totals.snapshot_totals(spark, str(tmp_path / "none")) is None


def test_landing_by_processing_time(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    drop(source, "a.json", [event(1)])
    lines = ev.read_lines(spark, str(source))
    query = ev.land(lines, out, str(tmp_path / "mark"), "2026-01-05", {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        drop(source, "b.json", [event(2)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(read_event_lines(spark, out), "event_id") == [("e1",), ("e2",)]
