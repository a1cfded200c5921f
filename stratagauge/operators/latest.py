"""One row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Iterable[Column]) -> DataFrame:
    """First row of each key in a total order.

    The rank filter lets Spark keep one row per key and map task before the shuffle, so a hot key
    costs at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def latest_measurement(
    events: DataFrame,
    key: str = "id_municipio",
    time: str = "timestamp_evento",
    tie_break: str = "evento_id",
) -> DataFrame:
    """Latest event per key; the highest id wins a tie, an event without time comes last."""
    order = [F.col(time).desc_nulls_last(), F.col(tie_break).desc_nulls_last()]
    return first_per_key(events, [key], order)


def event_order(columns: Sequence[str], key: str = "evento_id", time: str = "timestamp_evento") -> list[Column]:
    """Which copy of an event stays: the latest, and among equal times the one with the highest other values."""
    others = [F.col(name).desc_nulls_last() for name in columns if name not in (key, time)]
    return [F.col(time).desc_nulls_last(), *others]


def deduplicate_events(
    events: DataFrame, key: str = "evento_id", time: str = "timestamp_evento"
) -> DataFrame:
    """One row per event id: the latest copy, and among equal times the highest other values.

    Events without id are no copies of one another: all of them stay, for the quality rules to judge.
    """
    named, nameless = events.filter(F.col(key).isNotNull()), events.filter(F.col(key).isNull())
    return first_per_key(named, [key], event_order(events.columns, key, time)).unionByName(nameless)
