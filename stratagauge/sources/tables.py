"""Reading and writing path-addressed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratagauge.sources import snapshots
from stratagauge.sources.snapshots import Snapshot

#: Versions of a layer table that stay readable.
KEPT = 2


def scan(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source table: a path, or what the connector `fmt` calls a location.

    `columns` is pushed into the scan. `limit` takes any n rows, for development loads. For `jdbc` the
    location is the table; the options then name a partition column with its bounds and number of
    partitions, or say `numPartitions` = 1: a read in one task has to be asked for.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        df = reader.options(**jdbc_options(location, options or {})).load()
    else:
        df = reader.load(location)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


_JDBC_PARTS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(location: str, options: Mapping[str, str]) -> dict[str, str]:
    """The table for a JDBC read; refuses options that would read it in one task unasked."""
    given = {name.lower() for name in options}
    parallel = all(name.lower() in given for name in _JDBC_PARTS)
    alone = any(name.lower() == "numpartitions" and str(value) == "1" for name, value in options.items())
    if not parallel and not alone:
        raise ValueError(f"give {', '.join(_JDBC_PARTS)}, or numPartitions=1 to read in one task")
    return {} if "query" in given or "dbtable" in given else {"dbtable": location}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition: str | None = None,
    rebalance: bool | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Replace a layer table, partitioned if it has that column; returns the observed metrics.

    By default a partitioned table is rebalanced by that column: few files per partition, and a
    value that holds many rows is split over several writers. Other tables are written without a
    further shuffle. `rebalance` says otherwise: true for a table that a filter left nearly empty,
    false for a large one with few partition values. Plain files become a new version of the table, which
    readers see only when all of it is written (see `snapshots`); a job that fails leaves the table as it was.
    The last KEPT versions stay. The schema belongs to the version: plain files do not remember that of an
    empty partitioned table or the type of a partition column.
    """
    spark = df.sparkSession
    partitioned = partition is not None and partition in df.columns
    balanced = df
    if partitioned if rebalance is None else rebalance:
        balanced = df.hint("rebalance", *([F.col(partition)] if partitioned else []))
    # Observed in the writing stage: only there is every row counted once even if tasks are rerun.
    watched = Observation()
    balanced = balanced.observe(
        watched, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]
    )
    writer = balanced.write.format(fmt)
    if partitioned:
        writer = writer.partitionBy(partition)
    if fmt == "delta":
        writer.mode("overwrite").option("overwriteSchema", "true").save(path)
        return watched.get
    before = snapshots.latest(spark, path)
    version = before.version + 1 if before is not None else 0
    folder = snapshots.new_folder(version)
    writer.save(snapshots.location(path, folder))
    snapshots.commit(spark, path, Snapshot(version, {snapshots.WHOLE: (folder,)}, df.schema, fmt))
    if version >= KEPT:
        snapshots.vacuum(spark, path, KEPT)
    return watched.get


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a layer table, with the schema it was written with."""
    snapshot = None if fmt == "delta" else snapshots.latest(spark, path)
    return spark.read.format(fmt).load(path) if snapshot is None else snapshots.read(spark, path, snapshot)
