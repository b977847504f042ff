import pytest

from tests.conftest import rows
from tests.golden import EVENT, write_seeds
from tests.test_sources import inputs
from yardline import Lake
from yardline.__main__ import main


def test_run_with_landed_events(spark, tmp_path):
    root, seeds = str(tmp_path / "lake"), write_seeds(tmp_path / "csv")
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.json").write_text(EVENT + "\n")
    main(["land", "--root", root, "--events", str(tmp_path / "events"), "--ingestion-date", "2026-01-01", "--once"])
    main(["run", "--root", root, "--seeds-dir", seeds, "--ingestion-date", "2026-01-01"])
    fact = Lake(root).read(spark, "gold", "fato_alfabetizacao")
    assert rows(fact.filter("ano = 2024 and sigla_uf = 'SP'"), "qtd_avaliados") == [(1200,)]
    main(["quality", "--root", root])
    kept = spark.read.parquet(f"{root}/quality_results")
    assert kept.count() == 22 and kept.filter("not passed").count() == 0


def test_stages_one_by_one(spark, tmp_path):
    root, seeds = str(tmp_path / "lake"), write_seeds(tmp_path / "csv")
    main(["bronze", "--root", root, "--seeds-dir", seeds, "--table", "uf", "--table", "municipio"])
    for table in ("meta_brasil", "meta_uf", "meta_municipio", "alunos"):
        main(["bronze", "--root", root, "--seeds-dir", seeds, "--table", table])
    main(["silver", "--root", root])
    main(["gold", "--root", root])
    assert Lake(root).read(spark, "gold", "evolucao_temporal").count() == 3


def test_prepare(spark, tmp_path):
    given = inputs(tmp_path)
    arguments = ["prepare", "--out", str(tmp_path / "out"), "--states", given.states]
    arguments += ["--municipalities", given.municipalities]
    for option, files in (
        ("--entity-sheet", given.entity_sheets),
        ("--group-sheet", given.group_sheets),
        ("--microdata", given.microdata),
    ):
        for year, path in files.items():
            arguments += [option, f"{year}={path}"]
    main(arguments)
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "alunos.csv")).count() == 2


def test_bad_date_is_refused():
    with pytest.raises(SystemExit):
        main(["run", "--root", "x", "--ingestion-date", "01/02/2026"])
