"""Silver datasets as lazy plans over bronze tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagauge.config import STUDENT_COLUMNS, TARGET_COLUMNS
from stratagauge.functions import keys
from stratagauge.operators.clean import clean, fill_category
from stratagauge.operators.latest import deduplicate_events
from stratagauge.operators.lookup import decode
from stratagauge.operators.rates import weighted_rate
from stratagauge.operators.reshape import unpivot_targets
from stratagauge.operators.targets import with_trajectory
from stratagauge.streaming.bronze import good_events

Reader = Callable[[str], DataFrame]


def add_state(df: DataFrame) -> DataFrame:
    """State of the municipality id; an existing column is replaced."""
    return df.withColumn("sigla_uf", keys.by_prefix(F.col("id_municipio")))


def results(bronze: DataFrame, dictionary: DataFrame, table: str) -> DataFrame:
    """A cleaned result or student table with decoded network and grade."""
    df = clean(bronze)
    for column in ("rede", "serie"):
        df = decode(df, dictionary, column, table)
    return fill_category(df, ["rede_desc", "serie_desc"])


def targets(bronze: DataFrame) -> DataFrame:
    """A cleaned target table in long form; its network is already a label."""
    return unpivot_targets(clean(bronze), TARGET_COLUMNS)


def stream_events(bronze: DataFrame) -> DataFrame:
    """Readable events, cleaned, one row per event id."""
    return deduplicate_events(clean(good_events(bronze)))


def municipality_indicator(municipality: DataFrame, targets_long: DataFrame) -> DataFrame:
    """Results with the target trajectory of their edition, one row per target year."""
    return add_state(with_trajectory(municipality, targets_long))


def student_rates(students: DataFrame) -> DataFrame:
    return weighted_rate(students.select(*STUDENT_COLUMNS))


def silver_tables(read: Reader, read_events: Callable[[], DataFrame]) -> dict[str, DataFrame]:
    """All silver tables by name; `read` gives a bronze table, `read_events` the bronze events."""
    dictionary = read("dicionario")
    tables = {name: results(read(name), dictionary, name) for name in ("uf", "municipio", "alunos")}
    tables["indicador_stream"] = stream_events(read_events())
    for area in ("brasil", "uf", "municipio"):
        tables[f"meta_{area}"] = targets(read(f"meta_alfabetizacao_{area}"))
    tables["taxa_alunos_calc"] = student_rates(tables["alunos"])
    tables["indicador_municipio"] = municipality_indicator(tables["municipio"], tables["meta_municipio"])
    return tables
