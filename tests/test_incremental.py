"""Sums carried from run to run, and partitions that keep their files."""

import os
import shutil

import pytest

from tests.conftest import rows
from tests.golden import EVENT, write_seeds
from yardline import Lake
from yardline.plans import event_sums as es
from yardline.plans.pipeline import Run, run_stages
from yardline.session import materialise
from yardline.sources import lake as lake_files
from yardline.sources.lake import write_changed
from yardline.tables import EVENT_LANDING, EVENT_TABLE


def event_file(lake, date, lines, name="a.json", table=EVENT_TABLE):
    folder = os.path.join(lake.path("bronze", table), f"ingestion_date={date}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        file.write("\n".join(lines) + "\n")
    return os.path.join(folder, name)


def summed(spark, lake, date):
    found = es.event_sums(spark, lake, date)
    return found, rows(found.sums, "ano", "id_municipio", "rede", "qtd_avaliados", "qtd_alfabetizados", "score_weight")


def test_only_new_folders_are_opened(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    event_file(lake, "2026-01-01", [EVENT] * 3 + ["broken"])
    one, first = summed(spark, lake, "2026-01-01")
    event_file(lake, "2026-01-02", [EVENT])
    event_file(lake, "2026-01-03", [EVENT] * 2, table=EVENT_LANDING)
    two, second = summed(spark, lake, "2026-01-03")
    assert one.opened == ["2026-01-01"] and (one.rows, one.malformed) == (4, 1)
    assert two.opened == ["2026-01-02", "2026-01-03"] and (two.rows, two.malformed) == (3, 0)
    files = {f.rpartition("ingestion_date=")[2][:10] for f in two.lines.inputFiles()}
    assert files <= {"2026-01-02", "2026-01-03"}
    assert [r[3] for r in second] == [2 * r[3] for r in first]
    again, same = summed(spark, lake, "2026-01-03")  # a repeated run starts from the state before it
    assert again.opened == two.opened and same == second
    later, third = summed(spark, lake, "2026-01-04")
    assert later.opened == [] and later.lines is None and third == second
    early, back = summed(spark, lake, "2026-01-01")
    assert back == first and early.opened == ["2026-01-01"]


def test_folders_of_malformed_lines_only_are_counted(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    event_file(lake, "2026-01-01", [EVENT])
    _, first = summed(spark, lake, "2026-01-01")
    event_file(lake, "2026-01-02", ["{second", "{third"])
    found, second = summed(spark, lake, "2026-01-02")
    assert (found.rows, found.malformed) == (2, 2) and second == first


def test_late_files_are_never_missed(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    event_file(lake, "2026-01-01", [EVENT])
    summed(spark, lake, "2026-01-01")
    event_file(lake, "2026-01-02", [EVENT])
    summed(spark, lake, "2026-01-02")
    event_file(lake, "2026-01-02", [EVENT], "late.json")
    found, total = summed(spark, lake, "2026-01-03")
    assert found.opened == ["2026-01-02"]  # the state of the first date still holds
    event_file(lake, "2025-12-31", [EVENT])
    everything, more = summed(spark, lake, "2026-01-03")
    assert everything.opened == ["2025-12-31", "2026-01-01", "2026-01-02"]
    assert [r[3] * 4 for r in total] == [r[3] * 3 for r in more]


def test_unfinished_state_does_not_count(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    event_file(lake, "2026-01-01", [EVENT])
    summed(spark, lake, "2026-01-01")
    shutil.rmtree(tmp_path / "lake" / "state" / "event_sums" / "upto=2026-01-01" / "covered")
    event_file(lake, "2026-01-02", [EVENT])
    found, _ = summed(spark, lake, "2026-01-02")
    assert found.opened == ["2026-01-01", "2026-01-02"]


def test_no_events_and_undated_events(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert es.has_dates(spark, lake) and summed(spark, lake, "2026-01-01")[1] == []
    os.makedirs(lake.path("bronze", EVENT_TABLE))
    with open(os.path.join(lake.path("bronze", EVENT_TABLE), "x.json"), "w") as file:
        file.write(EVENT + "\n")
    assert not es.has_dates(spark, lake)


@pytest.mark.parametrize("deduplicate", [False, True])
def test_runs_equal_one_run_over_everything(spark, tmp_path, deduplicate):
    seeds = write_seeds(tmp_path / "csv")
    once, daily = Lake(str(tmp_path / "once")), Lake(str(tmp_path / "daily"))
    other = EVENT.replace("2024", "2025")
    for lake, dates in ((once, ["2026-01-02"] * 2), (daily, ["2026-01-01", "2026-01-02"])):
        for k, (date, lines) in enumerate(zip(dates, ([EVENT, other, "bad"], [EVENT, "{}"]), strict=True)):
            event_file(lake, date, lines, f"{k}.json")
            if lake is daily:
                run_stages(Run(spark, lake, date, seeds, deduplicate_events=deduplicate), ["bronze", "silver"])
    run_stages(Run(spark, once, "2026-01-02", seeds, deduplicate_events=deduplicate), ["bronze", "silver"])
    assert rows(once.read(spark, "silver", "alunos")) == rows(daily.read(spark, "silver", "alunos"))


# --- changed partitions -------------------------------------------------------------------


def files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")) for d in os.listdir(path) if "=" in d}


def frame(spark, data):
    return spark.createDataFrame(data, "year int, k bigint, v double, s string")


def test_only_changed_years_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(y, k, k / 3, f"s{k}") for y in (2023, 2024, 2025) for k in range(40)] + [(None, 1, None, None)]
    first = write_changed(frame(spark, data), path, "year", ["k"])
    assert len(first.written) == 4 and first.rows == 121
    before = files(path)
    same = write_changed(frame(spark, data[::-1]).repartition(5), path, "year", ["k"])
    assert same.written == [] and len(same.kept) == 4 and files(path) == before
    data[45] = (2024, 5, -1.0, "new")
    changed = write_changed(frame(spark, data), path, "year", ["k"])
    after = files(path)
    assert changed.written == ["year=2024"] and {d for d in before if before[d] != after[d]} == {"year=2024"}
    assert rows(spark.read.parquet(path), "year", "k", "v", "s") == rows(frame(spark, data))
    gone = write_changed(frame(spark, [r for r in data if r[0] != 2023]), path, "year", ["k"])
    assert gone.removed == ["year=2023"] and "year=2023" not in files(path) and gone.written == []


def test_duplicates_swaps_and_schema_changes_are_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(1, 1, 1.0, "a"), (1, 2, 2.0, "b"), (2, 1, 1.0, "a")]
    write_changed(frame(spark, data), path, "year")
    assert write_changed(frame(spark, [*data, data[0], data[0]]), path, "year").written == ["year=1"]
    assert write_changed(frame(spark, data), path, "year").written == ["year=1"]
    swapped = [(1, 1, 2.0, "a"), (1, 2, 1.0, "b"), (2, 1, 1.0, "a")]
    assert write_changed(frame(spark, swapped), path, "year").written == ["year=1"]
    wider = frame(spark, swapped).selectExpr("*", "1 as extra")
    assert len(write_changed(wider, path, "year").written) == 2 and "extra" in spark.read.parquet(path).columns


def test_foreign_and_broken_files_mend(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(1, 1, 1.0, "a"), (2, 1, 1.0, "a")]
    write_changed(frame(spark, data), path, "year")
    (name,) = files(path)["year=2"]
    os.remove(os.path.join(path, "year=2", name))  # as after a lost write
    assert write_changed(frame(spark, data), path, "year").written == ["year=2"]
    shutil.rmtree(os.path.join(path, "_checksums"))
    assert len(write_changed(frame(spark, data), path, "year").written) == 2
    plain = str(tmp_path / "plain")
    frame(spark, data).write.parquet(plain)
    assert len(write_changed(frame(spark, data), plain, "year").written) == 2 and rows(spark.read.parquet(plain), "year", "k") == [(1, 1), (2, 1)]
    empty = str(tmp_path / "empty")
    assert write_changed(frame(spark, []), empty, "year").rows == 0 and os.path.isdir(empty)


def test_a_new_table_is_computed_and_written_once(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(lake_files, "materialise", lambda df, purpose: staged.append(purpose) or materialise(df, purpose))
    path, table = str(tmp_path / "t"), spark.createDataFrame([(2024, 1), (2025, 2), (None, 3)], "ano int, v int")
    first = write_changed(table, path, "ano")
    assert not staged and (len(first.written), first.kept, first.rows) == (3, [], 3)
    second = write_changed(table.filter("v <> 2"), path, "ano")
    assert staged == ["changed"] and (second.written, len(second.kept), second.removed) == ([], 2, ["ano=2025"])
    assert rows(spark.read.parquet(path), "ano", "v") == [(None, 3), (2024, 1)]
    empty = write_changed(table.limit(0), str(tmp_path / "e"), "ano")
    assert (empty.written, empty.rows) == ([], 0) and spark.read.schema(table.schema).parquet(str(tmp_path / "e")).count() == 0


def test_text_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.createDataFrame([("a b", 1), ("x/y=z", 2), ("é", 3), ("", 4), (None, 5), ("10%", 6)], "p string, v int")
    assert len(write_changed(data, path, "p").written) == 5
    assert rows(spark.read.parquet(path), "v") == [(k,) for k in range(1, 7)]
    assert write_changed(data, path, "p").written == []
