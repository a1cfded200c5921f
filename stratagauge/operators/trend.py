"""Trend of a yearly series: least-squares projection and the risk of missing a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagauge.functions import measures

#: Sums are taken as whole numbers of 10^-10, so that a series of equal values has no slope.
_UNITS = 1e10
_SUMS = ("_n", "_sx", "_sxx", "_sy", "_sxy")


def _sums(x: Column, y: Column, when: Column) -> list[Column]:
    """Exact sums for a fitted line, over the rows that have a value; one that does not fit counts as none."""
    y = measures.exact(y, "decimal(26,10)")
    x = F.when(when & y.isNotNull(), x.cast("long"))
    y = F.when(x.isNotNull(), y)
    terms = (F.count(x), F.sum(x), F.sum(x * x), F.sum(y), F.sum(x.try_cast("decimal(5,0)") * y))
    return [term.alias(name) for term, name in zip(terms, _SUMS)]


def _value_at(x: int) -> Column:
    """The fitted line at x, rounded; NULL when all rows are of one year."""
    n, sx, sxx = (F.col(name).cast("double") for name in _SUMS[:3])
    sy, sxy = (F.round(F.lit(_UNITS) * F.col(name).cast("double")) for name in _SUMS[3:])
    # Exact, because a tiny rest in place of zero would make a slope out of nothing.
    wide_n, wide_sx, wide_sxx = (F.col(name).cast("decimal(19,0)") for name in _SUMS[:3])
    spread = (wide_n * wide_sxx - wide_sx * wide_sx).cast("double")
    line = sy * (sxx - F.lit(x) * sx) + sxy * (F.lit(x) * n - sx)
    return F.when(spread != 0, measures.rounded(line / (F.lit(_UNITS) * spread)))


def project(
    series: DataFrame,
    keys: Sequence[str],
    at: int,
    origin: int,
    year: str = "ano_ref",
    value: str = "valor",
) -> DataFrame:
    """(keys, anos, projecao): number of yearly values and the fitted value for the year `at`.

    Keys with values of only one year have no trend and are left out. `origin` only shifts the
    years to keep the sums small.
    """
    x = F.col(year) - F.lit(origin)
    fitted = series.groupBy(*keys).agg(*_sums(x, F.col(value), F.lit(True)))
    return fitted.select(
        *keys, F.col("_n").alias("anos"), _value_at(at - origin).alias("projecao")
    ).filter(F.col("projecao").isNotNull())


def target_risk(evolution: DataFrame, at: int = 2030, origin: int = 2019) -> DataFrame:
    """Projected value, target and expected gap per territory and network for the year `at`.

    `em_risco` is true when the projection stays below the target, NULL when one of them is missing.
    """
    actual = F.col("tipo") == "realizado"
    is_target = (F.col("tipo") == "meta") & (F.col("ano_ref") == at)
    sums = _sums(F.col("ano_ref") - F.lit(origin), F.col("valor"), actual)
    grouped = evolution.groupBy("id_municipio", "sigla_uf", "rede_desc").agg(
        *sums, F.max(F.when(is_target, F.col("valor"))).alias("meta")
    )
    projected = grouped.withColumn("projecao", _value_at(at - origin))
    return projected.select(
        "id_municipio", "sigla_uf", "rede_desc",
        F.col("_n").alias("anos"),
        "projecao",
        "meta",
        measures.gap(F.col("meta"), F.col("projecao")).alias("gap_pp"),
        (F.col("projecao") < F.col("meta")).alias("em_risco"),
    )
