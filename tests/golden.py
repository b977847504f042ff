"""The golden fixture: two cities, two years, one streamed event."""

from yardline.tables import BATCH_TABLES

# The published fixture rows, which the expected results belong to.
UF = [(35, "SP", "Sao Paulo", 3, "Sudeste"), (33, "RJ", "Rio de Janeiro", 3, "Sudeste")]
MUNICIPIO = [(3550308, "Sao Paulo", "SP", 35), (3304557, "Rio de Janeiro", "RJ", 33)]
META_BRASIL = [(2024, 54.0), (2025, 60.0)]
META_UF = [(2024, "SP", 72.0), (2025, "SP", 74.0), (2024, "RJ", 70.0), (2025, "RJ", 72.0)]
META_MUNICIPIO = [
    (2024, 3550308, 74.0),
    (2025, 3550308, 74.0),
    (2024, 3304557, 68.0),
    (2025, 3304557, 68.0),
]
ALUNOS = [
    (2024, 3550308, "publica", 1000, 800, 750.0),
    (2025, 3550308, "publica", 1000, 830, 755.0),
    (2024, 3304557, "publica", 500, 300, 720.0),
]
EVENT = (
    '{"event_id": "e1", "event_time": "2026-01-01T00:00:00+00:00", "event_type": "medicao", '
    '"ano": 2024, "id_municipio": 3550308, "rede": "publica", "qtd_avaliados": 200, '
    '"qtd_alfabetizados": 180, "media_proficiencia": 760.0}'
)

SOURCES = {
    "uf": UF,
    "municipio": MUNICIPIO,
    "meta_brasil": META_BRASIL,
    "meta_uf": META_UF,
    "meta_municipio": META_MUNICIPIO,
    "alunos": ALUNOS,
}
HEADERS = {name: ",".join(spec.schema.names) for name, spec in BATCH_TABLES.items()}


def write_seeds(folder, extra=None):
    folder.mkdir(parents=True, exist_ok=True)
    for name, data in SOURCES.items():
        lines = [HEADERS[name], *(",".join(str(v) for v in row) for row in data)]
        lines += (extra or {}).get(name, [])
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def write_events(root, lines, date="2026-01-01", name="part-0.json"):
    folder = root / "bronze" / "alunos_streaming" / f"ingestion_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
