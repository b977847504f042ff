import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from yardline.names import DOMAIN as N
from yardline.operators import marts, microdata, reshape
from yardline.operators.clean import clean, drop_technical, newest_per_key, typed
from yardline.operators.integrate import (
    add_sums,
    finish,
    first_per_event,
    grain_sums,
    integrate,
)
from yardline.sources.readers import with_parent
from yardline.tables import BATCH_TABLES, batch_table, entity_spec

MEASURES = (
    "ano int, id_municipio long, rede string, qtd_avaliados long, "
    "qtd_alfabetizados long, media_proficiencia double"
)
DIMENSION = (
    "id_municipio long, nome_municipio string, sigla_uf string, id_uf int, "
    "nome_uf string, nome_regiao string"
)
TOTAL = (
    "ano int, id_municipio long, nome_municipio string, sigla_uf string, id_uf int, "
    "nome_regiao string, qtd_avaliados long, qtd_alfabetizados long, indicador_pct double"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- tables and cleaning ---------------------------------------------------------------


def test_registry_has_the_six_sources():
    assert list(BATCH_TABLES) == ["uf", "municipio", "meta_brasil", "meta_uf", "meta_municipio", "alunos"]
    assert batch_table("municipio").seed_file == "municipio.csv"
    assert batch_table("municipio").warehouse_table == "br_bd_diretorios_brasil.municipio"
    assert batch_table("meta_uf").key == ("ano", "sigla_uf")
    with pytest.raises(KeyError):
        batch_table("nope")


def test_clean_keeps_the_newest_row_and_breaks_ties_by_content(spark):
    raw = spark.createDataFrame(
        [
            ("35", " sp ", "b", "3", "r", "2026-01-02", "2026-01-02 00:00:00"),
            ("35", "SP", "a", "3", "r", "2026-01-02", "2026-01-02 00:00:00"),
            ("35", "SP", "0", "3", "r", "2026-01-01", "2026-01-01 00:00:00"),
            ("x", "SP", "bad id", "3", "r", "2026-01-02", "2026-01-02 00:00:00"),
            ("33", None, "no code", "3", "r", "2026-01-02", "2026-01-02 00:00:00"),
        ],
        "id_uf string, sigla_uf string, nome_uf string, id_regiao string, nome_regiao string, "
        "ingestion_date string, ingested_at string",
    )
    result = clean(raw, batch_table("uf"))
    assert rows(result) == [(35, "SP", "a", 3, "r")]
    assert result.columns == ["id_uf", "sigla_uf", "nome_uf", "id_regiao", "nome_regiao"]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as v")
    text = plan(newest_per_key(df, ["k"], ["v"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_missing_required_column_is_an_error_and_optional_is_not(spark):
    df = spark.createDataFrame([(1, "a")], "id_municipio long, nome_municipio string")
    assert typed(df, entity_spec()).columns == ["id_municipio", "nome_municipio"]
    with pytest.raises(ValueError):
        typed(df.drop("id_municipio"), entity_spec())


def test_technical_columns_are_dropped_when_present(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, ingested_at int, ingestion_date int")
    assert drop_technical(df).columns == ["a"]


# --- integration -----------------------------------------------------------------------


def test_null_scores_count_in_the_weight_unless_excluded(spark):
    df = spark.createDataFrame(
        [(2024, 1, "p", 100, 10, None), (2024, 1, "p", 100, 10, 700.0)], MEASURES
    )
    sums = grain_sums(df)
    assert finish(sums).first().media_proficiencia == 350.0
    assert finish(sums, null_scores="exclude").first().media_proficiencia == 700.0


def test_rows_without_a_key_fall_out_and_zero_assessed_gives_null(spark):
    df = spark.createDataFrame(
        [
            (None, 1, "p", 1, 1, 1.0),
            (2024, None, "p", 1, 1, 1.0),
            (2024, 1, None, 1, 1, 1.0),
            (2024, 1, "p", 0, 0, 1.0),
        ],
        MEASURES,
    )
    assert rows(finish(grain_sums(df)), "media_proficiencia", "indicador_pct") == [(None, None)]


def test_unknown_entity_keeps_its_row_with_null_attributes(spark):
    batch = spark.createDataFrame([(2024, 1, "p", 10, 5, 1.0), (2024, 9, "p", 10, 5, 1.0)], MEASURES)
    dimension = spark.createDataFrame([(1, "a", "SP", 35, "Sao Paulo", "Sudeste")], DIMENSION)
    result = integrate(batch, None, dimension)
    assert rows(result, "id_municipio", "sigla_uf") == [(1, "SP"), (9, None)]
    total = marts.consolidated(result)
    targets = spark.createDataFrame([(2024, "SP", 40.0)], "ano int, sigla_uf string, meta_indicador double")
    compared = marts.group_comparison(total, targets)
    assert rows(compared, "sigla_uf", "meta_uf", "atingiu_meta") == [(None, None, None), ("SP", 40.0, True)]


def test_segment_vocabularies_stay_apart_and_are_added_in_totals(spark):
    batch = spark.createDataFrame([(2024, 1, "municipal", 10, 5, 1.0)], MEASURES)
    stream = spark.createDataFrame([(2024, 1, "publica", 10, 10, 1.0)], MEASURES)
    dimension = spark.createDataFrame([(1, "a", "SP", 35, "Sao Paulo", "Sudeste")], DIMENSION)
    result = integrate(batch, stream, dimension)
    assert rows(result, "rede", "indicador_pct") == [("municipal", 50.0), ("publica", 100.0)]
    assert marts.consolidated(result).first().indicador_pct == 75.0


def test_sums_of_parts_equal_sums_of_all(spark):
    rng = random.Random(1)
    data = [
        (2024 + rng.randrange(2), rng.randrange(3), rng.choice("ab"), rng.randrange(50), 3, float(rng.randrange(9)))
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, MEASURES)
    first, second = df.filter("qtd_avaliados < 20"), df.filter("qtd_avaliados >= 20")
    parts = add_sums(grain_sums(first).unionByName(grain_sums(second)))
    assert rows(finish(parts)) == rows(finish(grain_sums(df)))


def test_event_dedup_keeps_one_per_id_and_all_without_id(spark):
    events = spark.createDataFrame(
        [("a", "2"), ("a", "1"), ("b", "1"), (None, "x"), (None, "x")], "event_id string, v string"
    )
    assert rows(first_per_event(events)) == [(None, "x"), (None, "x"), ("a", "1"), ("b", "1")]
    assert "WindowGroupLimit" in plan(first_per_event(events))


# --- marts -----------------------------------------------------------------------------


def total_rows(spark, pairs):
    data = [(y, 1, "a", "SP", 35, "Sudeste", 10, 5, p) for y, p in pairs]
    return spark.createDataFrame(data, TOTAL)


def test_previous_year_is_the_previous_available_one_unless_strict(spark):
    total = total_rows(spark, [(2024, 50.0), (2026, 55.5)])
    loose = marts.evolution(total)
    assert rows(loose, "ano", "indicador_ano_anterior", "variacao_pp") == [
        (2024, None, None), (2026, 50.0, 5.5),
    ]
    strict = marts.evolution(total, strict=True)
    assert rows(strict, "ano", "variacao_pp") == [(2024, None), (2026, None)]


def test_rounded_indicator_is_compared_with_the_unrounded_target(spark):
    total = total_rows(spark, [(2024, 59.9)])
    targets = spark.createDataFrame([(2024, 1, 59.8978)], "ano int, id_municipio long, meta_indicador double")
    row = marts.indicator(total, targets).first()
    assert (row.atingiu_meta, row.gap_meta_pp) == (True, 0.0)


def test_region_summary_is_a_mean_over_entities(spark):
    data = [
        (2025, 1, "a", "SP", 35, "Sudeste", 1000, 900, 90.0, 80.0, True, 10.0),
        (2025, 2, "b", "SP", 35, "Sudeste", 10, 1, 10.0, 80.0, False, -70.0),
        (2025, 3, "c", None, None, None, 10, 2, 20.0, None, None, None),
    ]
    mart = spark.createDataFrame(
        data, TOTAL + ", meta_municipio double, atingiu_meta boolean, gap_meta_pp double"
    )
    found = rows(marts.region_summary(mart))
    assert found == [
        (2025, None, False, 20.0, 1, None),
        (2025, None, True, 40.0, 3, 50.0),
        (2025, "Sudeste", False, 50.0, 2, 50.0),
    ]


# --- reshape ---------------------------------------------------------------------------


def test_wide_sheet_to_rows(spark):
    sheet = spark.createDataFrame(
        [(1, ">80", "0", "x", "1"), (2, "-", "45.5", "x", "1")],
        "id_municipio long, META_FINAL_2024 string, META_FINAL_2025 string, "
        "META_FINAL_20255 string, META_PARCIAL_2024 string",
    )
    assert rows(reshape.wide_to_long(sheet, "id_municipio")) == [(1, 2024, 80.0), (2, 2025, 45.5)]
    with pytest.raises(ValueError):
        reshape.wide_to_long(sheet.select("id_municipio"), "id_municipio")


def brute_reconcile(versions):
    """The rule of the reshape module as a plain loop."""
    every = sorted({y for v in versions.values() for unit in v.values() for y in unit})
    result = {}
    for unit in {u for v in versions.values() for u in v}:
        complete = [s for s in sorted(versions) if sorted(versions[s].get(unit, {})) == every]
        if not complete:
            continue
        base = versions[complete[-1]][unit]
        for older in complete:
            if all(round(versions[older][unit][y]) == round(base[y]) for y in every):
                result[unit] = {y: round(v, 4) for y, v in versions[older][unit].items()}
                break
    return result


def long_rows(spark, versions):
    frames = {
        s: spark.createDataFrame(
            [(u, y, v) for u, path in units.items() for y, v in path.items()],
            "sigla_uf string, ano int, meta_indicador double",
        )
        for s, units in versions.items()
    }
    return reshape.stack_versions(frames)


def test_reconciliation_cases(spark):
    versions = {
        2023: {
            "same": {2024: 50.4, 2025: 60.2},
            "differs": {2024: 50.4, 2025: 61.9},
            "half": {2024: 50.5, 2025: 60.5},
            "never": {2024: 1.0},
            "fallback": {2024: 40.1, 2025: 41.1},
        },
        2024: {
            "same": {2024: 50.3, 2025: 60.1},
            "differs": {2024: 50.4, 2025: 61.8},
            "half": {2024: 50.4, 2025: 60.4},
            "never": {2025: 1.0},
            "fallback": {2024: 55.0, 2025: 56.0},
        },
        2025: {
            "same": {2024: 50.0, 2025: 60.0},
            "differs": {2024: 50.0, 2025: 60.0},
            "half": {2024: 50.0, 2025: 60.0},
            "fallback": {2024: 55.0},
        },
    }
    found = {}
    for unit, year, value in rows(reshape.reconcile(long_rows(spark, versions), "sigla_uf")):
        found.setdefault(unit, {})[year] = value
    assert found == brute_reconcile(versions)
    assert found["same"] == {2024: 50.4, 2025: 60.2}
    assert found["differs"] == {2024: 50.0, 2025: 60.0}
    assert found["half"] == {2024: 50.5, 2025: 60.5}
    assert found["fallback"] == {2024: 55.0, 2025: 56.0}
    assert "never" not in found


def test_reconciliation_against_brute_force(spark):
    rng = random.Random(7)
    versions = {s: {} for s in (2023, 2024, 2025)}
    for i in range(300):
        exact = {y: rng.randrange(40, 60) + rng.choice([0.0, 0.25, 0.5, 0.75]) for y in range(2024, 2028)}
        for s in versions:
            path = dict(exact) if s < 2025 else {y: float(round(v)) for y, v in exact.items()}
            if rng.random() < 0.3:
                path[2025] += rng.choice([1.0, 0.25])
            if rng.random() < 0.2:
                del path[rng.randrange(2024, 2028)]
            if rng.random() < 0.95:
                versions[s][f"u{i}"] = path
    found = {}
    for unit, year, value in rows(reshape.reconcile(long_rows(spark, versions), "sigla_uf")):
        found.setdefault(unit, {})[year] = value
    assert found == brute_reconcile(versions)


def test_two_targets_for_one_year_in_a_version_are_an_error(spark):
    frame = spark.createDataFrame(
        [("a", 2024, 1.0), ("a", 2024, 1.0)], "sigla_uf string, ano int, meta_indicador double"
    )
    with pytest.raises(PySparkException, match="more than one target"):
        reshape.reconcile(reshape.stack_versions({2023: frame}), "sigla_uf").collect()


def test_reconciliation_shuffles_units_once_after_the_first_aggregation(spark):
    frame = spark.createDataFrame([("a", 2024, 1.0)], "sigla_uf string, ano int, meta_indicador double")
    text = plan(reshape.reconcile(reshape.stack_versions({2023: frame, 2024: frame}), "sigla_uf"))
    outer = [line for line in text.split("\n") if "Exchange hashpartitioning(sigla_uf" in line]
    assert len(outer) == 2 and "Join" not in text


# --- microdata and parents --------------------------------------------------------------

PERSONS = (
    "ano int, entity long, network int, present double, filled double, weight double, "
    "score double, flag double"
)


def test_weighted_microdata(spark):
    df = spark.createDataFrame(
        [
            (2024, 1, 3, 1.0, 1.0, 2.0, 700.0, 1.0),
            (2024, 1, 3, 1.0, 1.0, 1.0, 750.0, 0.0),
            (2024, 1, 3, 1.0, 1.0, 1.0, None, None),
            (2024, 1, 3, 0.0, 1.0, 9.0, 1.0, 1.0),
            (2024, 1, 3, 1.0, 0.0, 9.0, 1.0, 1.0),
            (2024, None, 3, 1.0, 1.0, 9.0, 1.0, 1.0),
            (2024, 1, None, 1.0, 1.0, 9.0, 1.0, 1.0),
            (2024, 2, 5, 1.0, 1.0, 1.0, 700.25, 1.0),
            (2024, 3, 1, 1.0, 1.0, None, 700.0, 1.0),
            (2024, 4, 2, 1.0, 1.0, 1.0, 700.35, 1.0),
        ],
        PERSONS,
    )
    found = rows(microdata.weighted_microdata(df), "id_municipio", "rede", *N.measures[3:])
    assert found == [
        (1, "municipal", 3, 2, 537.5),
        (2, None, 1, 1, 700.2),
        (3, "federal", 1, None, None),
        (4, "estadual", 1, 1, 700.4),
    ]


def test_finer_sums_add_up_to_the_same_microdata(spark):
    rng = random.Random(3)
    data = [
        (2024, rng.randrange(4), rng.randrange(1, 6), 1.0, 1.0, float(rng.randrange(1, 9)), float(rng.randrange(600, 800)), float(rng.randrange(2)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, PERSONS).withColumn("school", F.col("weight"))
    whole = microdata.weighted_microdata(df)
    fine = microdata.weighted_sums(microdata.counted(df), ["ano", "entity", "network", "school"])
    added = fine.groupBy("ano", "entity", "network").agg(
        *[F.sum(c).alias(c) for c in ("n", "w", "w_flag", "w_score")]
    )
    assert rows(microdata.finish_microdata(added)) == rows(whole)


def test_unknown_parent_is_an_error(spark):
    parents = spark.createDataFrame([(35, "SP", "Sudeste")], "id_uf int, sigla_uf string, nome_regiao string")
    known = spark.createDataFrame([(3550308, "Sao Paulo")], "id_municipio long, nome_municipio string")
    assert rows(with_parent(known, parents)) == [(3550308, "Sao Paulo", "SP", 35, "Sudeste")]
    lost = spark.createDataFrame([(9950308, "x")], "id_municipio long, nome_municipio string")
    with pytest.raises(PySparkException, match="no parent for id 9950308"):
        with_parent(lost, parents).collect()
