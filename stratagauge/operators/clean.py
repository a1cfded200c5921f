"""Bronze to silver cleaning; every step touches only the columns that are present."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagauge.config import INGEST_COLUMNS, UNKNOWN_LABEL
from stratagauge.functions import keys

_KEY_FORMS = {
    "id_municipio": keys.territory,
    "sigla_uf": keys.state,
    "ano": keys.year,
    "rede": keys.code,
    "serie": keys.code,
}


def normalize_keys(df: DataFrame) -> DataFrame:
    present = [name for name in _KEY_FORMS if name in df.columns]
    return df.withColumns({name: _KEY_FORMS[name](F.col(name)) for name in present})


def drop_ingest_columns(df: DataFrame) -> DataFrame:
    return df.drop(*INGEST_COLUMNS)


def fill_category(df: DataFrame, columns: Iterable[str], label: str = UNKNOWN_LABEL) -> DataFrame:
    """Label missing categories; measures keep their NULL."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns(
        {name: F.coalesce(F.col(name).cast("string"), F.lit(label)) for name in present}
    )


def clean(df: DataFrame) -> DataFrame:
    return df.transform(drop_ingest_columns).transform(normalize_keys)


def oversized_ids(df: DataFrame, column: str = "id_municipio", width: int = 7) -> DataFrame:
    """Rows whose id is longer than its format allows."""
    return df.filter(keys.oversized(F.col(column), width))
