"""The quality suite over Silver and Gold, and the gate."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Row

from yardline.names import DOMAIN, Names
from yardline.operators.checks import (
    CRITICAL,
    AtMost,
    Filled,
    InRange,
    Refers,
    Rule,
    Unique,
)

log = logging.getLogger(__name__)


class QualityGateError(RuntimeError):
    """One or more critical rules failed."""


def silver_suite(n: Names = DOMAIN) -> list[tuple[str, list[Rule]]]:
    # Published names of the rules.
    return [
        (
            "municipio",
            [
                Unique("municipio.chave_unica", (n.entity,)),
                Filled("municipio.sem_nulos", (n.entity, n.group_code)),
                Refers("municipio.fk_uf", (n.group,), "uf", (n.group,)),
            ],
        ),
        (
            "alunos",
            [
                Unique("alunos.grao_unico", tuple(n.grain)),
                Filled("alunos.sem_nulos", (*n.grain, n.pct)),
                InRange("alunos.indicador_0_100", n.pct, 0, 100),
                AtMost("alunos.alfabetizados_leq_avaliados", n.reached, n.assessed),
                Refers("alunos.fk_municipio", (n.entity,), "municipio", (n.entity,)),
            ],
        ),
        (
            "meta_municipio",
            [
                Unique("meta_municipio.grao_unico", (n.year, n.entity)),
                Refers("meta_municipio.fk_municipio", (n.entity,), "municipio", (n.entity,)),
            ],
        ),
    ]


def gold_suite(n: Names = DOMAIN) -> list[tuple[str, list[Rule]]]:
    # Published names of the rules.
    return [("indicador_municipio", [InRange("gold.indicador_0_100", n.pct, 0, 100)])]


def outcome(results: DataFrame) -> list[Row]:
    """Collect the results, one small row per rule, and log them."""
    rows = results.collect()
    for row in rows:
        log.info("[%s] %s: %s", "ok" if row.passed else "failed", row["name"], row.details)
    return rows


def raise_on_failure(rows: list[Row]) -> None:
    """Raise if a critical rule failed; warnings pass."""
    failed = [row["name"] for row in rows if not row.passed and row.severity == CRITICAL]
    if failed:
        raise QualityGateError(f"critical rule(s) failed: {', '.join(sorted(failed))}")


def gate(results: DataFrame) -> list[Row]:
    rows = outcome(results)
    raise_on_failure(rows)
    return rows
