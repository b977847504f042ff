"""Column vocabulary.

Every operator takes a ``Names`` so the same plan runs on the literacy tables
(the defaults) or on any other entity / group / year / segment data.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Names:
    # The published column names of the literacy tables.
    year: str = "ano"
    entity: str = "id_municipio"
    entity_label: str = "nome_municipio"
    group: str = "id_uf"
    group_code: str = "sigla_uf"
    group_label: str = "nome_uf"
    region_id: str = "id_regiao"
    region: str = "nome_regiao"
    segment: str = "rede"
    assessed: str = "qtd_avaliados"
    reached: str = "qtd_alfabetizados"
    score: str = "media_proficiencia"
    pct: str = "indicador_pct"
    target: str = "meta_indicador"
    entity_target: str = "meta_municipio"
    group_target: str = "meta_uf"
    met: str = "atingiu_meta"
    gap: str = "gap_meta_pp"
    previous: str = "indicador_ano_anterior"
    change: str = "variacao_pp"

    @property
    def grain(self) -> list[str]:
        return [self.year, self.entity, self.segment]

    @property
    def measures(self) -> list[str]:
        return [*self.grain, self.assessed, self.reached, self.score]


DOMAIN = Names()
