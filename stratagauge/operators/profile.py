"""Reports: counts, profiles, attainment, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagauge.functions import measures

# The names of the audit report.
AUDITED_KEYS = {
    "id_municipio": "id_municipio_nulo",
    "ano": "ano_nulo",
    "sigla_uf": "sigla_uf_nula",
}


def mean_by(
    df: DataFrame,
    by: str = "sigla_uf",
    value: str = "taxa_alfabetizacao",
    count_name: str = "eventos",
    mean_name: str = "taxa_media",
    digits: int | None = None,
) -> DataFrame:
    """Row count and mean (1 decimal) per group, largest group first.

    Values are summed as decimals, or with `digits` as whole units of 10^-digits, so the order of the
    rows does not matter. A value that does not fit is not part of the mean.
    """
    if digits is None:
        units = measures.exact(F.col(value))
    else:
        units = measures.units(measures.number(F.col(value)), digits)
    total = F.sum(units).cast("double") / F.lit(float(10 ** (digits or 0)))
    mean = F.try_divide(total, F.count(units))
    return (
        df.groupBy(by)
        .agg(F.count(F.lit(1)).alias(count_name), F.round(mean, 1).alias(mean_name))
        .orderBy(F.desc(count_name), by)
    )


def null_audit(df: DataFrame, columns: Mapping[str, str] = AUDITED_KEYS) -> DataFrame:
    """One row with the number of NULLs of each column; `columns` maps it to its result name."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(result) for name, result in columns.items()])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) for each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def comparable(indicator: DataFrame, year: int, network: str | None = None) -> DataFrame:
    """Rows of one year that have a target, of one network if given."""
    rows = indicator.filter((F.col("ano") == year) & F.col("meta_ano").isNotNull())
    return rows if network is None else rows.filter(F.col("rede_desc") == network)


def attainment(indicator: DataFrame, year: int, network: str | None = None) -> DataFrame:
    return (
        comparable(indicator, year, network)
        .groupBy("atingiu_meta")
        .agg(F.count(F.lit(1)).alias("qtd_municipios"))
    )


def largest_gaps(indicator: DataFrame, year: int, n: int = 15, network: str | None = None) -> DataFrame:
    """The n rows furthest below target; ties are ordered by key."""
    return (
        comparable(indicator, year, network)
        .select(
            "id_municipio", "sigla_uf", "rede_desc", "serie",
            "taxa_realizada", "meta_ano", "gap_pp", "atingiu_meta",
        )
        .orderBy(F.desc("gap_pp"), "id_municipio", "rede_desc", "serie")
        .limit(n)
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def spread(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Highest and lowest value of each group and their distance in points."""
    return df.groupBy(*by).agg(
        F.max(value).alias("maximo"),
        F.min(value).alias("minimo"),
        measures.rounded(F.max(value) - F.min(value)).alias("amplitude_pp"),
    )
