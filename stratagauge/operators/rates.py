"""Weighted rates from microdata.

Weights are summed as decimals, so the result is exact and does not depend on the order of the rows.
Where the source is known to have few digits, they can be summed as whole units of 10^-digits, which
is several times faster. The sums can be merged: a table can be summed by a fine key first, joined
small, and merged to a coarser key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagauge.config import PROFICIENCY_CUTOFF
from stratagauge.functions import measures

_HIT, _WEIGHT, _ROWS = "_hit", "_weight", "_rows"


def partial_sums(
    students: DataFrame,
    keys: Sequence[str],
    cutoff: float = PROFICIENCY_CUTOFF,
    score: str = "proficiencia",
    weight: str = "peso_aluno",
    digits: int | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Weight at or above the cutoff, total weight and row count of each key.

    Rows without a score are left out and a missing weight counts 1. Without `digits` sums are
    decimals with room for 1e10 rows of the largest weight; a weight that does not fit (infinite, or 1e18
    and more) leaves its row out, and so does the quality check of the student table, with the reason
    `peso_aluno_fora_da_faixa` for it. With `digits` sums are units of
    10^-digits in 64 bits, for weights that are known to be small.
    """
    value, given = measures.number(F.col(score)), measures.number(F.col(weight))
    if digits is None:
        units = F.coalesce(measures.exact(F.col(weight)), F.when(given.isNull(), F.lit(1).cast(measures.EXACT)))
    else:
        units = measures.units(F.coalesce(given, F.lit(1.0)), digits)
    return (
        students.filter(value.isNotNull() & units.isNotNull())
        .groupBy(*keys)
        .agg(
            F.sum(F.when(value >= F.lit(cutoff), units).otherwise(F.lit(0))).alias(_HIT),
            F.sum(units).alias(_WEIGHT),
            F.count(F.lit(1)).alias(_ROWS),
            *extra,
        )
    )


def merge_sums(partials: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Add partial sums up to coarser keys, as decimals that have room for any number of them."""
    names = [_HIT, _WEIGHT, _ROWS, *extra]
    whole = {name for name, kind in partials.dtypes if kind == "bigint"}
    return partials.groupBy(*keys).agg(
        *[F.sum(F.col(n).cast("decimal(19,0)") if n in whole else F.col(n)).alias(n) for n in names]
    )


def rates_from_sums(
    partials: DataFrame,
    keys: Sequence[str],
    rate: str = "taxa_alfabetizacao_calc",
    total: str = "peso_total",
    rows: str = "qtd_alunos",
    digits: int | None = None,
) -> DataFrame:
    weight = F.col(_WEIGHT).cast("double") / F.lit(float(10 ** (digits or 0)))
    return partials.select(
        *keys,
        measures.percent(F.col(_HIT), F.col(_WEIGHT)).alias(rate),
        F.round(weight, 1).alias(total),
        F.col(_ROWS).cast("long").alias(rows),
    )


def weighted_rate(
    students: DataFrame,
    keys: Sequence[str] = ("id_municipio", "ano", "rede"),
    cutoff: float = PROFICIENCY_CUTOFF,
    digits: int | None = None,
) -> DataFrame:
    """Share of the weight whose score reaches the cutoff, with the total weight and row count."""
    return rates_from_sums(partial_sums(students, keys, cutoff, digits=digits), keys, digits=digits)
