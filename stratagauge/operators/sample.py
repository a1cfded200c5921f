"""Samples that depend on the rows' keys alone: the same rows on every run, cluster and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash values are below 16^DIGITS.
DIGITS = 15


def hash_value(keys: Sequence[str]) -> Column:
    """A number below 16^DIGITS from the first digits of the md5 of the keys, joined by "|"; NULL reads as nothing."""
    text = F.concat_ws("|", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def stable_sample(df: DataFrame, keys: Sequence[str], percent: float) -> DataFrame:
    """About `percent` percent of the keys with all of their rows; a filter in the scan, without a shuffle.

    A larger percentage holds the smaller one, and tables that share the key are sampled alike.
    """
    return df.filter(hash_value(keys) < F.lit(int(16**DIGITS * percent / 100)))


def bottom_k(df: DataFrame, strata: Sequence[str], keys: Sequence[str], k: int) -> DataFrame:
    """The k rows of each stratum whose keys have the smallest hash values; ties go by key.

    Every task keeps k rows of a stratum before the shuffle, so a stratum of any size costs k rows per task.
    """
    window = Window.partitionBy(*strata).orderBy(hash_value(keys), *keys)
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= k).drop("_place")
