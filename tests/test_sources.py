import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from tests.conftest import rows
from tests.golden import write_seeds
from yardline import Lake
from yardline.plans import source_prep
from yardline.plans.pipeline import Run, run_stages
from yardline.session import build_session, materialise, remove_scratch, scratch_dir
from yardline.sources import readers
from yardline.sources.lake import child_names, write_csv, write_parquet
from yardline.tables import batch_table


def test_layer_paths():
    lake = Lake("data")
    assert lake.path("bronze", "uf") == "data/bronze/uf"
    buckets = Lake("s3a://root", {"gold": "s3a://my-gold"})
    assert buckets.path("gold", "fato") == "s3a://my-gold/fato"
    assert buckets.path("silver", "uf") == "s3a://root/silver/uf"
    with pytest.raises(KeyError):
        lake.path("platinum", "uf")


def test_scratch_is_below_the_shared_checkpoint_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second
    kept = materialise(spark.range(3), "three")
    assert kept.count() == 3 and shared in kept.inputFiles()[0]


def test_scratch_tables_of_one_folder_go_together(spark):
    folder = scratch_dir(spark, "early")
    gone, kept = materialise(spark.range(3), "a", within=folder), materialise(spark.range(4), "b", compression="zstd")
    assert gone.count() == 3 and all(folder.split("/")[-1] in f for f in gone.inputFiles())
    remove_scratch(spark, folder)
    assert not Path(folder.removeprefix("file:")).exists() and kept.count() == 4
    assert all(".zstd." in f for f in kept.inputFiles())


def test_session_settings(spark):
    session = build_session("again")
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"


def test_swapped_csv_header_is_an_error(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "meta_brasil.csv").write_text("meta_indicador,ano\n50.0,2024\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.read_seed(spark, batch_table("meta_brasil"), str(folder)).collect()


def test_seed_types_are_declared(spark, tmp_path):
    df = readers.read_seed(spark, batch_table("alunos"), write_seeds(tmp_path / "csv"))
    assert df.drop(readers.CORRUPT).schema == batch_table("alunos").schema
    assert df.count() == 3


def test_a_write_replaces_all_partitions(spark, tmp_path):
    for day in ("a", "b"):
        df = spark.createDataFrame([(1, day)], "v int, d string")
        write_parquet(df, f"{tmp_path}/t", partition_by=["d"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "d") == [("b",)]


MICRODATA = "TP_DEPENDENCIA;CO_MUNICIPIO;IN_PRESENCA_LP;IN_PREENCHIMENTO_LP;VL_PESO_ALUNO_LP;VL_PROFICIENCIA_LP;IN_ALFABETIZADO"


def test_microdata_by_the_header_of_each_file(spark, tmp_path):
    folder = tmp_path / "micro" / "ano=2024"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_bytes(f"{MICRODATA};NO_PROVA\n3;9007199254740993;1;1;1.5;700.25;1;avaliação\n".encode("latin-1"))
    turned = ";".join(reversed(MICRODATA.split(";")))
    (folder / "b.csv").write_text(f'"{turned}"\n'.replace(";", '";"') + "0;650.5;2.5;1;1;1100015;2\n\n")
    want = [(2024, 2, 1100015, 1.0, 1.0, 2.5, 650.5, 0.0), (2024, 3, 9007199254740993, 1.0, 1.0, 1.5, 700.25, 1.0)]
    for files in (str(tmp_path / "micro"), {2024: str(folder)}):
        got = readers.read_microdata(spark, files)
        assert [tuple(float(v) if i > 2 else v for i, v in enumerate(r)) for r in rows(got)] == want
    (folder / "c.csv").write_text("1;2;3\n")
    with pytest.raises(Exception, match="no header in"):
        readers.read_microdata(spark, str(tmp_path / "micro")).collect()


def test_sheets_of_one_folder_must_have_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CO_MUNICIPIO,META_FINAL_2024\n9007199254740993,70\n")
    assert rows(readers.read_entity_sheet(spark, str(tmp_path)), "id_municipio") == [(9007199254740993,)]
    (tmp_path / "b.csv").write_text("META_FINAL_2024,CO_MUNICIPIO\n70,12\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.read_entity_sheet(spark, str(tmp_path)).collect()


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    """Most rows share one year; rebalancing splits them by size and keeps every row."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 200000, 1, 8).selectExpr(
            "id", "uuid() as text", "if(id < 150000, 2024, 2025 + cast(id % 3 as int)) as ano"
        )
        write_parquet(df, f"{tmp_path}/hot", partition_by=["ano"], sort_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [n for n in child_names(spark, f"{tmp_path}/hot/ano=2024") if n.startswith("part-")]
    assert len(files) > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 200000


def test_small_partitions_become_few_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "cast(id % 2 as int) as ano")
    write_parquet(df, f"{tmp_path}/small", partition_by=["ano"])
    for year in (0, 1):
        names = child_names(spark, f"{tmp_path}/small/ano={year}")
        assert len([n for n in names if n.startswith("part-")]) == 1


def test_csv_export_projects_and_orders(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", 0), (1, "a", 0)], "k int, v string, extra int")
    write_csv(df, f"{tmp_path}/out", ["v", "k"], ["k"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    assert [line for line in text.splitlines() if line != "v,k"] == ["a,1", "b,2"]


SHEET = "CO_MUNICIPIO,NO_MUNICIPIO,META_FINAL_2024,META_FINAL_2025\n"
GROUPS = "NOME_UF,SIGLA_UF,META_FINAL_2024,META_FINAL_2025\n"
HEADER = (
    "NU_ANO;TP_DEPENDENCIA;NO_ESCOLA;CO_MUNICIPIO;IN_PRESENCA_LP;IN_PREENCHIMENTO_LP;"
    "VL_PESO_ALUNO_LP;VL_PROFICIENCIA_LP;IN_ALFABETIZADO\n"
)


def inputs(folder):
    def put(name, text, encoding="utf-8"):
        path = folder / name
        path.write_text(text, encoding=encoding)
        return str(path)

    region = {"id": 3, "nome": "Sudeste"}
    states = [
        {"id": 35, "sigla": "SP", "nome": "São Paulo", "regiao": region},
        {"id": 33, "sigla": "RJ", "nome": "Rio de Janeiro", "regiao": region},
    ]
    cities = [{"id": 3550308, "nome": "São Paulo"}, {"id": 3304557, "nome": "Rio de Janeiro"}]
    return source_prep.Inputs(
        states=put("states.json", json.dumps(states, indent=1)),
        municipalities=put("cities.json", json.dumps(cities, indent=1)),
        entity_sheets={
            2023: put("c23.csv", SHEET + "3550308,SP,70.4,74.2\n3304557,RJ,50.0,-\n"),
            2025: put("c25.csv", SHEET + "3550308.0,SP,70,74\n3304557,RJ,>80,81\nTotal,,1,1\n"),
        },
        group_sheets={
            2023: put("u23.csv", GROUPS + "São Paulo,SP*,71.1,72.2\nBrasil,,60.12345,64\n,SP,1,1\n"),
            2025: put("u25.csv", GROUPS + "São Paulo,SP,0,72\nBrasil,,60,64\n"),
        },
        microdata={
            2024: put(
                "m24.csv",
                HEADER
                + "2024;3;Praça;3550308;1;1;2.0;700.0;1\n"
                + "2024;3;Praça;3550308;1;1;1.0;760.0;0\n"
                + "2024;3;Praça;3550308;0;1;1.0;760.0;0\n",
                "latin-1",
            ),
            2025: put("m25.csv", HEADER + "2025;2;Praça;3304557;1;1;1.0;720.0;1\n", "latin-1"),
        },
    )


def test_sources_are_prepared_and_run_through_all_layers(spark, tmp_path):
    seeds = str(tmp_path / "seeds")
    source_prep.prepare(spark, inputs(tmp_path), seeds)

    def seed(name):
        return rows(readers.read_seed(spark, batch_table(name), seeds).drop(readers.CORRUPT))

    assert seed("uf") == [(33, "RJ", "Rio de Janeiro", 3, "Sudeste"), (35, "SP", "São Paulo", 3, "Sudeste")]
    assert seed("municipio") == [(3304557, "Rio de Janeiro", "RJ", 33), (3550308, "São Paulo", "SP", 35)]
    assert seed("meta_brasil") == [(2024, 60.1234), (2025, 64.0)]
    assert seed("meta_uf") == [(2024, "SP", 71.1), (2025, "SP", 72.2)]
    assert seed("meta_municipio") == [
        (2024, 3304557, 80.0), (2024, 3550308, 70.4), (2025, 3304557, 81.0), (2025, 3550308, 74.2),
    ]
    assert seed("alunos") == [
        (2024, 3550308, "municipal", 2, 1, 720.0), (2025, 3304557, "estadual", 1, 1, 720.0),
    ]
    lake = Lake(str(tmp_path / "lake"))
    run_stages(Run(spark, lake, "2026-01-01", seeds))
    fact = lake.read(spark, "gold", "fato_alfabetizacao")
    assert rows(fact, "ano", "sigla_uf", "indicador_pct", "meta_municipio", "atingiu_meta") == [
        (2024, "SP", 50.0, 70.4, False), (2025, "RJ", 100.0, 81.0, True),
    ]


def test_missing_state_of_a_municipality_is_an_error(spark, tmp_path):
    given = inputs(tmp_path)
    (tmp_path / "cities.json").write_text('[{"id": 9900000, "nome": "x"}]')
    states = readers.read_states(spark, given.states)
    with pytest.raises(PySparkException, match="no parent"):
        readers.read_municipalities(spark, given.municipalities, states).collect()
