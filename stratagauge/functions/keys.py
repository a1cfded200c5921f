"""Column expressions for keys and codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratagauge.config import STATE_BY_PREFIX


def text(value: Column) -> Column:
    return value.cast("string")


def territory(value: Column, width: int = 7) -> Column:
    """Zero-padded id; a longer one keeps all of its characters."""
    return padded(value, width)


def padded(value: Column, width: int) -> Column:
    """Zeros in front of what is shorter than `width`; `lpad` alone would cut what is longer."""
    return F.lpad(text(value), F.greatest(F.lit(width), F.length(text(value))), F.lit("0"))


def oversized(value: Column, width: int = 7) -> Column:
    return F.length(text(value)) > width


def state(value: Column) -> Column:
    return F.upper(F.trim(text(value)))


def code(value: Column) -> Column:
    return F.trim(text(value))


def year(value: Column) -> Column:
    return value.try_cast("int")


def by_prefix(value: Column, labels: Mapping[str, str] = STATE_BY_PREFIX) -> Column:
    """Label of the id prefix; the prefix length is that of the map's keys."""
    width = len(next(iter(labels)))
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.create_map(*pairs)[F.substring(value, 1, width)]
