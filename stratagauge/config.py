"""Names, rules and layer layout shared by the whole package."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: column names, labels and rules of the data model -------------------------
# They have to equal what the source tables and the consumers of the results use.

INGEST_COLUMNS = ("data_ingestao", "data_ingestao_dt", "fonte", "tipo_ingestao")
INGEST_DATE = "data_ingestao_dt"

BATCH_TABLES = (
    "uf",
    "municipio",
    "meta_alfabetizacao_brasil",
    "meta_alfabetizacao_uf",
    "meta_alfabetizacao_municipio",
    "alunos",
    "dicionario",
)
STREAM_TABLE = "indicador_streaming"
STREAM_ORIGIN = "indicador-alfabetizacao"

PROFICIENCY_CUTOFF = 743
TARGET_COLUMNS = tuple(f"meta_alfabetizacao_{year}" for year in range(2024, 2031))
UNKNOWN_LABEL = "Não informado"
PUBLIC_NETWORK = "Pública (Estadual e Municipal)"
STATE_TARGET_NETWORK = "Pública"

# Columns of the student table that the indicators read.
STUDENT_COLUMNS = ("id_municipio", "ano", "rede", "proficiencia", "peso_aluno")

PRIMARY_KEYS = {
    "uf": ("sigla_uf", "ano", "rede", "serie"),
    "municipio": ("id_municipio", "ano", "rede", "serie"),
    "meta_alfabetizacao_brasil": ("ano", "rede"),
    "meta_alfabetizacao_uf": ("sigla_uf", "ano", "rede"),
    "meta_alfabetizacao_municipio": ("id_municipio", "ano", "rede"),
    "alunos": ("id_aluno", "ano"),
}

PERCENT_RANGE = (0.0, 100.0)
YEAR_RANGE = (2019, 2030)
PROFICIENCY_RANGE = (0.0, 1000.0)
# Weights that exact sums have room for.
WEIGHT_RANGE = (0.0, 9.99e17)

# First two digits of a municipality id -> state.
STATE_BY_PREFIX = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA",
    "31": "MG", "32": "ES", "33": "RJ", "35": "SP",
    "41": "PR", "42": "SC", "43": "RS",
    "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

# First digit of a municipality id -> region.
REGION_BY_PREFIX = {"1": "Norte", "2": "Nordeste", "3": "Sudeste", "4": "Sul", "5": "Centro-Oeste"}
# --- End of fixed values --------------------------------------------------------------------


@dataclass(frozen=True)
class QualitySpec:
    """What is checked on one silver table.

    Its key, the closed range of each column, and optionally (column, silver table) where each value
    of the column has to exist.
    """

    keys: tuple[str, ...]
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    reference: tuple[str, str] | None = None


#: Silver tables that list all territories of a kind, and the column that holds them.
_DIRECTORY_KEYS = {"municipio": "id_municipio", "uf": "sigla_uf"}


def _spec(keys: tuple[str, ...], measure: str, span: tuple[float, float], directory: str | None = None, **more) -> QualitySpec:
    """A measure and a year in range; the territory exists in a directory table, if one is named."""
    reference = (_DIRECTORY_KEYS[directory], directory) if directory else None
    return QualitySpec(keys, {measure: span, "ano": YEAR_RANGE, **more}, reference)


def _long(table: str) -> tuple[str, ...]:
    """Key of a target table in long form."""
    return (*PRIMARY_KEYS[table], "ano_meta")


QUALITY_SPECS = {
    "municipio": _spec(PRIMARY_KEYS["municipio"], "taxa_alfabetizacao", PERCENT_RANGE),
    "uf": _spec(PRIMARY_KEYS["uf"], "taxa_alfabetizacao", PERCENT_RANGE),
    "meta_municipio": _spec(_long("meta_alfabetizacao_municipio"), "valor_meta", PERCENT_RANGE, "municipio"),
    "meta_uf": _spec(_long("meta_alfabetizacao_uf"), "valor_meta", PERCENT_RANGE, "uf"),
    "indicador_stream": _spec(("evento_id",), "taxa_alfabetizacao", PERCENT_RANGE, "municipio"),
    # Asked for by the data model, although the result tables do not depend on it.
    "alunos": _spec(PRIMARY_KEYS["alunos"], "proficiencia", PROFICIENCY_RANGE, "municipio", peso_aluno=WEIGHT_RANGE),
}


@dataclass(frozen=True)
class Layers:
    """Where the tables of one environment live, and in which file format."""

    base: str
    fmt: str = "parquet"

    def bronze(self, table: str) -> str:
        return f"{self.base}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.base}/silver/{table}"

    def checked(self, table: str) -> str:
        """Silver rows with their quality result, partitioned by it."""
        return f"{self.base}/silver_avaliada/{table}"

    def gold(self, table: str) -> str:
        return f"{self.base}/gold/{table}"

    def quarantine(self, table: str) -> str:
        return f"{self.base}/quarentena/{table}"

    @property
    def landing(self) -> str:
        return f"{self.base}/streaming/eventos"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.base}/streaming/_checkpoints"
