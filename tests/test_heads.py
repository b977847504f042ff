"""Headers found in the heads of files: title lines, column orders, one scan of the data."""

import gzip

import pytest

from tests.conftest import rows
from yardline.sources import heads, readers

MICRO = "TP_DEPENDENCIA;CO_MUNICIPIO;IN_PRESENCA_LP;IN_PREENCHIMENTO_LP;VL_PESO_ALUNO_LP;VL_PROFICIENCIA_LP;IN_ALFABETIZADO"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_titles_above_the_header(spark, tmp_path):
    put(tmp_path / "a" / "one.csv", 'Metas, "2024"\n\nCO_MUNICIPIO,NO_MUNICIPIO,META_FINAL_2024,\n12,"Rio, do Sul",70.5,x\n\n13,B,80,\n')
    put(tmp_path / "a" / "two.csv", "CO_MUNICIPIO,NO_MUNICIPIO,META_FINAL_2024,\n14,C,90,z\n")
    sheet = readers.read_entity_sheet(spark, str(tmp_path / "a"))
    assert sheet.columns == ["CO_MUNICIPIO", "NO_MUNICIPIO", "META_FINAL_2024", "_c3", "id_municipio"]
    assert rows(sheet, "id_municipio", "NO_MUNICIPIO", "META_FINAL_2024") == [(12, "Rio, do Sul", "70.5"), (13, "B", "80"), (14, "C", "90")]
    put(tmp_path / "b.csv", "Metas por UF\r\nNOME_UF,SIGLA_UF,META_FINAL_2024\r\nBrasil,,60\r\nRio,RJ*,61\r\n")
    assert rows(readers.read_group_sheet(spark, str(tmp_path / "b.csv")), "sigla_uf", "META_FINAL_2024") == [("BR", "60"), ("RJ", "61")]


def test_plain_sheets_are_read_as_before(spark, tmp_path):
    path = put(tmp_path / "s.csv", "CO_MUNICIPIO,META_FINAL_2024\n12,70\n")
    assert "FileScan csv" in readers.read_entity_sheet(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_sheets_without_or_with_other_headers_are_errors(spark, tmp_path):
    put(tmp_path / "n" / "a.csv", "1,2\n3,4\n")
    with pytest.raises(ValueError, match="no header"):
        readers.read_entity_sheet(spark, str(tmp_path / "n"))
    put(tmp_path / "m" / "a.csv", "T\nCO_MUNICIPIO,META_FINAL_2024\n1,2\n")
    put(tmp_path / "m" / "b.csv", "5,6\n")
    with pytest.raises(ValueError, match="none is found"):
        readers.read_entity_sheet(spark, str(tmp_path / "m"))


def test_only_a_bounded_head_is_fetched(spark, tmp_path):
    path = put(tmp_path / "long.csv", "a;b\n" + "x;y\n" * 100_000)
    lines = heads.first_lines(spark, spark.read.text(path).inputFiles()[0], 50)
    assert lines[:2] == ["a;b", "x;y"] and len(lines) == 12
    late = put(tmp_path / "late.csv", "x" * heads.HEAD_BYTES + f"\n{MICRO}\n")
    assert heads.find_heads(spark, spark.read.text(late).inputFiles(), MICRO.split(";"), heads.plain_cells(";")) == {}


def test_packed_files_and_odd_names(spark, tmp_path):
    folder = tmp_path / "micro data" / "ano=2024"
    folder.mkdir(parents=True)
    with gzip.open(folder / "a é.csv.gz", "wt") as file:
        file.write(f"Avaliação 2024\n{MICRO}\n3;11;1;1;1.5;700;1\n")
    turned = ";".join(reversed(MICRO.split(";")))
    put(folder / "b c%20.csv", f"{turned}\r\n0;650;2;1;1;12;2\r\n")
    got = readers.read_microdata(spark, str(tmp_path / "micro data"))
    assert rows(got.filter("entity is not null"), "entity", "network", "flag") == [(11, 3, 1.0), (12, 2, 0.0)]


def test_data_are_scanned_once(spark, tmp_path):
    folder = tmp_path / "micro" / "ano=2024"
    put(folder / "a.csv", f"{MICRO}\n3;11;1;1;1.5;700;1\n")
    frame = readers.read_microdata(spark, str(tmp_path / "micro"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "headers" not in plan
