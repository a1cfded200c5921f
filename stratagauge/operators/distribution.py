"""Distribution of a measure within groups: exact percentiles, Gini coefficient, and mergeable sketches.

Exact positions need no sort of a group in one task: equal values are counted first, the counts are
range-partitioned by (group, value), and prefix sums over the partitions' totals give every value its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagauge.functions import measures
from stratagauge.operators.joins import left_lookup

#: Size of a sketch. Its rank error is about 2.3 / k^0.9 (99 % of the time): 0.6 % of the rows here.
SKETCH, SKETCH_ERROR = 800, 0.006
_PART, _N, _BEFORE, _TOTAL = "_part", "_n", "_before", "_total"


def positions(df: DataFrame, by: Sequence[str], value: str, path: str) -> DataFrame:
    """(by, value, _n, _before, _total): how often each value occurs, how many rows of its group are below, and in all.

    NULL values are left out. The counts are written once to `path`, since two steps have to see the same cuts.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias(_N))
    cut = counts.repartitionByRange(*by, value).withColumn(_PART, F.spark_partition_id())
    cut.write.parquet(path)
    staged = df.sparkSession.read.schema(cut.schema).parquet(path)
    # One row for each partition that a group lies in.
    parts = staged.groupBy(_PART, *by).agg(F.sum(_N).alias(_TOTAL))
    group = Window.partitionBy(*by)
    before = F.sum(_TOTAL).over(group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col(_PART).alias("_key"), *[F.col(b).alias(f"_key_{b}") for b in by],
        F.coalesce(before, F.lit(0)).alias("_offset"), F.sum(_TOTAL).over(group).alias(_TOTAL),
    )
    placed = left_lookup(staged, parts, {_PART: "_key", **{b: f"_key_{b}" for b in by}}, nulls_match=True)
    inside = Window.partitionBy(_PART, *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_offset") + F.coalesce(F.sum(_N).over(inside), F.lit(0))
    return placed.withColumn(_BEFORE, below).drop(_PART, "_offset")


def _at(value: str, percent: int) -> Column:
    """The smallest value that at least `percent` percent of the rows do not exceed."""
    reached = (F.col(_BEFORE) + F.col(_N)) * 100 >= F.col(_TOTAL) * percent
    return F.min(F.when(reached, F.col(value)))


def _gini(value: str, digits: int) -> Column:
    """Mean distance of two rows by twice the mean, from exact sums over ranks; NULL if the values sum up to nothing."""
    whole = "decimal(38,0)"
    units, n = measures.units(F.col(value), digits).cast("decimal(18,0)"), F.col(_N).cast("decimal(10,0)")
    # Twice the sum of the ranks of all rows that have this value.
    ranks = n * (F.col(_BEFORE).cast("decimal(10,0)") * 2 + n + 1)
    total, weighted = F.sum((units * n).cast(whole)), F.sum((units * ranks).cast(whole))
    rows = F.max(_TOTAL)
    top = (weighted - (rows + 1).cast("decimal(11,0)") * total).cast("double")
    return F.round(F.try_divide(top, rows.cast("double") * total.cast("double")), 6)


def distribution(
    df: DataFrame, by: Sequence[str], value: str, path: str, percents: Sequence[int] = (10, 50, 90), digits: int = 1
) -> DataFrame:
    """Rows, percentiles `p10`, ... and `gini` of each group; exact, and independent of the partitioning.

    Values are taken as whole units of 10^-digits for the Gini coefficient. It is meant for groups of up to 10^10 rows.
    """
    ranked = positions(df, by, value, path)
    named = [_at(value, percent).alias(f"p{percent}") for percent in percents]
    return ranked.groupBy(*by).agg(F.sum(_N).alias("linhas"), *named, _gini(value, digits).alias("gini"))


def sketches(df: DataFrame, by: Sequence[str], value: str, k: int = SKETCH) -> DataFrame:
    """(by, esboco): a quantile sketch of each group, of a size that does not grow with the group."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("esboco"))


def merge_sketches(sketched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, or of a table and its new load, without reading the rows again."""
    return sketched.groupBy(*by).agg(F.kll_merge_agg_double("esboco").alias("esboco"))


def sketched_percentiles(sketched: DataFrame, by: Sequence[str], percents: Sequence[int] = (10, 50, 90)) -> DataFrame:
    """Percentiles from sketches, within SKETCH_ERROR of the rank that is asked for."""
    at = [F.kll_sketch_get_quantile_double("esboco", F.lit(p / 100)).alias(f"p{p}") for p in percents]
    return sketched.select(*by, F.kll_sketch_get_n_double("esboco").alias("linhas"), *at)
