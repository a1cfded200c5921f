"""The join shape shared by all lookups."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    condition: Column | None = None,
    nulls_match: bool = False,
) -> DataFrame:
    """Left outer join on `{left column: right column}`; the right key columns are dropped.

    No broadcast is forced: Spark broadcasts the right side when its size, estimated or measured,
    is below the threshold, and otherwise shuffles both sides. The null-safe comparison is hashed
    differently from a plain group-by on the same columns, so a right side that was just grouped
    gets its own shuffle. Only then may adaptive execution split a hot key of the left side.
    """
    hidden = {column: f"_right_{i}" for i, column in enumerate(on.values())}
    right = right.withColumnsRenamed(hidden)
    if not nulls_match:
        right = right.dropna(subset=list(hidden.values()))
    terms = [left[ours].eqNullSafe(right[hidden[theirs]]) for ours, theirs in on.items()]
    if condition is not None:
        terms.append(condition)
    return left.join(right, reduce(and_, terms), "left").drop(*hidden.values())


def missing_in(df: DataFrame, key: str, directory: DataFrame, directory_key: str | None = None) -> DataFrame:
    """Rows whose key does not exist in the directory."""
    known = directory.select(F.col(directory_key or key).alias("_known"))
    return df.join(known, df[key] == known["_known"], "left_anti")


#: Bits of a key filter: 16 for each key, and no more than these; 2^21 rows of a broadcast at most.
MOST_BITS = 1 << 27


def missing_behind_filter(df: DataFrame, key: str, directory: DataFrame, directory_key: str | None = None) -> DataFrame:
    """The rows of `missing_in`, with only those shuffled that may exist in the directory.

    A bitmap over hashes of the directory's keys is built with an aggregation and broadcast; its size is bounded by
    MOST_BITS. A row whose bit is not set is missing for sure; all others go through the exact anti join. It pays
    where most rows are missing and the directory is too large to be broadcast.
    """
    known = directory.select(F.col(directory_key or key).alias("_known")).filter("_known is not null")
    bits = 1 << 10
    while bits < min(16 * known.count(), MOST_BITS):
        bits <<= 1
    at = F.pmod(F.xxhash64("_known"), F.lit(bits))
    words = (
        known.select(at.alias("_at"))
        .groupBy(F.floor(F.col("_at") / 64).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 as int))")).alias("_bits"))
    )
    # The key is hashed in the directory's type, so that equal keys have equal hashes.
    mine = F.pmod(F.xxhash64(F.col(key).cast(known.schema["_known"].dataType)), F.lit(bits))
    marked = df.withColumn("_place", mine).join(F.broadcast(words), F.floor(F.col("_place") / 64) == F.col("_word"), "left")
    hit = F.coalesce(F.expr("shiftright(_bits, cast(_place % 64 as int)) & 1"), F.lit(0)) == 1
    sure = marked.filter(~hit | F.col(key).isNull()).select(*df.columns)
    maybe = marked.filter(hit & F.col(key).isNotNull()).select(*df.columns)
    return sure.unionByName(missing_in(maybe, key, directory, directory_key))
