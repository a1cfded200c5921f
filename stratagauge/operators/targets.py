"""Actual values against targets.

Result tables carry network codes and target tables carry network labels, so every join uses the
decoded label of the result side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagauge.functions import measures
from stratagauge.operators.joins import left_lookup
from stratagauge.operators.latest import first_per_key


def latest_targets(targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One target per key: that of the latest edition, the higher value on a tie."""
    order = [F.col("ano").desc_nulls_last(), F.col("valor_meta").desc_nulls_last()]
    return first_per_key(targets.select(*keys, "ano", "valor_meta"), keys, order).drop("ano")


def with_target(
    actual: DataFrame, targets: DataFrame, on: dict[str, str], condition: Column | None = None
) -> DataFrame:
    """Add `meta_ano` and `gap_pp`; rows without a target stay. At most one target per key."""
    joined = left_lookup(actual, targets.withColumnRenamed("valor_meta", "meta_ano"), on, condition)
    return joined.withColumn("gap_pp", measures.gap(F.col("meta_ano"), F.col("taxa_realizada")))


def with_trajectory(actual: DataFrame, targets: DataFrame) -> DataFrame:
    """Add every target year of the edition of the actual year, one row for each."""
    editions = targets.select(
        F.col("id_municipio").alias("_id"),
        F.col("ano").alias("_edition"),
        F.col("rede").alias("_label"),
        "ano_meta",
        F.col("valor_meta").alias("meta_taxa_alfabetizacao"),
    )
    return left_lookup(
        actual, editions, {"id_municipio": "_id", "ano": "_edition", "rede_desc": "_label"}
    )
