"""The chain from measurements to marts against plain loops on random rows."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.conftest import rows
from yardline.operators import marts
from yardline.operators.integrate import integrate
from yardline.plans import reports

MEASURES = (
    "ano int, id_municipio long, rede string, qtd_avaliados long, "
    "qtd_alfabetizados long, media_proficiencia double"
)


def half_up(number, digits=1):
    step = Decimal(1).scaleb(-digits)
    return float(Decimal(repr(number)).quantize(step, ROUND_HALF_UP))


def percent(part, whole):
    return half_up(100 * part / whole) if whole else None


def optional(function, *values):
    return None if any(v is None for v in values) else function(*values)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)

    def measure():
        assessed = rng.choice([0, 1, 7, 40, 333])
        return (
            rng.choice([2023, 2024, 2026, None]) if rng.random() < 0.98 else None,
            rng.choice([1, 1, 1, 2, 3, 4, 9, None]),
            rng.choice(["publica", "privada"]),
            assessed,
            rng.randint(0, assessed),
            rng.choice([None, float(rng.randint(600, 800))]),
        )

    groups = [(10, "AA", "Aa", 1, "North"), (20, "BB", "Bb", 2, "South")]
    entities = [(1, "one", "AA", 10), (2, "two", "AA", 10), (3, "three", "BB", 20), (4, "four", None, 30)]
    entity_targets = [(y, e, rng.randint(20, 70) + 0.25) for y in (2023, 2024) for e in (1, 3)]
    group_targets = [(2023, "AA", 50.0), (2024, "BB", 51.3751)]
    batch, stream = [measure() for _ in range(150)], [measure() for _ in range(60)]
    return groups, entities, entity_targets, group_targets, batch, stream


@pytest.fixture(scope="module")
def frames(spark, data):
    groups, entities, entity_targets, group_targets, batch, stream = data
    dimension = marts.dimension(
        spark.createDataFrame(entities, "id_municipio long, nome_municipio string, sigla_uf string, id_uf int"),
        spark.createDataFrame(groups, "id_uf int, sigla_uf string, nome_uf string, id_regiao int, nome_regiao string"),
    )
    measures = integrate(
        spark.createDataFrame(batch, MEASURES), spark.createDataFrame(stream, MEASURES), dimension
    ).cache()
    targets = spark.createDataFrame(entity_targets, "ano int, id_municipio long, meta_indicador double")
    by_group = spark.createDataFrame(group_targets, "ano int, sigla_uf string, meta_indicador double")
    return measures, targets, by_group


def grains(data):
    sums = defaultdict(lambda: [0, 0, 0.0, False])
    for year, entity, segment, assessed, reached, score in [*data[4], *data[5]]:
        if year is None or entity is None:
            continue
        held = sums[year, entity, segment]
        held[0] += assessed
        held[1] += reached
        if score is not None:
            held[2] += score * assessed
            held[3] = True
    return sums


def totals(data):
    sums = defaultdict(lambda: [0, 0])
    for (year, entity, _), (assessed, reached, *_) in grains(data).items():
        sums[year, entity][0] += assessed
        sums[year, entity][1] += reached
    return sums


def test_integrated_measures(data, frames):
    code = {e: c for e, _, c, _ in data[1]}
    expected = {}
    for (year, entity, segment), (assessed, reached, weighted, scored) in grains(data).items():
        mean = half_up(weighted / assessed) if assessed and scored else None
        expected[year, entity, segment] = (
            code.get(entity), assessed, reached, mean, percent(reached, assessed),
        )
    found = frames[0].select(
        "ano", "id_municipio", "rede", "sigla_uf", "qtd_avaliados", "qtd_alfabetizados",
        "media_proficiencia", "indicador_pct",
    )
    assert {tuple(r[:3]): tuple(r[3:]) for r in found.collect()} == expected


def test_indicator_and_fact(data, frames):
    target = {(y, e): v for y, e, v in data[2]}

    def compared(value, key):
        goal = target.get(key)
        return (
            value, goal, optional(lambda a, b: a >= b, value, goal),
            optional(lambda a, b: half_up(a - b), value, goal),
        )

    expected = {k: compared(percent(r, a), k) for k, (a, r) in totals(data).items()}
    columns = ["indicador_pct", "meta_municipio", "atingiu_meta", "gap_meta_pp"]
    mart = marts.indicator(marts.consolidated(frames[0]), frames[1])
    found = {(r.ano, r.id_municipio): tuple(r[c] for c in columns) for r in mart.collect()}
    assert found == expected
    fact = marts.fact(frames[0], frames[1])
    found = {(r.ano, r.id_municipio, r.rede): tuple(r[c] for c in columns) for r in fact.collect()}
    assert found == {
        k: compared(percent(v[1], v[0]), k[:2]) for k, v in grains(data).items()
    }


def test_evolution(data, frames):
    series = defaultdict(dict)
    for (year, entity), (assessed, reached) in totals(data).items():
        series[entity][year] = percent(reached, assessed)
    expected = {}
    for entity, values in series.items():
        years = sorted(values)
        for year, before in zip(years, [None, *years], strict=False):
            previous = values.get(before)
            change = optional(lambda a, b: half_up(a - b), values[year], previous)
            expected[year, entity] = (previous, change)
    found = marts.evolution(marts.consolidated(frames[0])).collect()
    assert {(r.ano, r.id_municipio): (r.indicador_ano_anterior, r.variacao_pp) for r in found} == expected


def test_group_comparison(data, frames):
    place = {e: (c, dict((g[0], g[4]) for g in data[0]).get(g)) for e, _, c, g in data[1]}
    target = {(y, c): v for y, c, v in data[3]}
    sums = defaultdict(lambda: [0, 0])
    for (year, entity), (assessed, reached) in totals(data).items():
        held = sums[(year, *place.get(entity, (None, None)))]
        held[0] += assessed
        held[1] += reached
    expected = {}
    for (year, code, region), (assessed, reached) in sums.items():
        value, goal = percent(reached, assessed), target.get((year, code))
        expected[year, code, region] = (
            value, goal, optional(lambda a, b: a >= b, value, goal),
            optional(lambda a, b: half_up(a - b), value, goal),
        )
    mart = marts.group_comparison(marts.consolidated(frames[0]), frames[2])
    columns = ["indicador_pct", "meta_uf", "atingiu_meta", "gap_meta_pp"]
    found = {(r.ano, r.sigla_uf, r.nome_regiao): tuple(r[c] for c in columns) for r in mart.collect()}
    assert found == expected


def test_feature_table_keeps_the_change_against_the_year_before(data, frames):
    total = marts.consolidated(frames[0])
    evolution = marts.evolution(total)
    features = reports.feature_table(marts.indicator(total, frames[1]), evolution, 2024)
    expected = rows(evolution.filter("ano = 2024"), "id_municipio", "variacao_pp")
    assert rows(features, "id_municipio", "variacao_pp") == expected
    assert any(change is not None for _, change in expected)
