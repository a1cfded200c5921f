"""Tables that keep a count of their keys, so that repeated keys are found without moving the rows.

Rows are dealt into hash buckets of their key once, when a load comes in. A second table keeps a row per key and load,
written from the buckets. A check sums these narrow rows and joins the repeated keys to the rows where they lie: both
sides have the buckets' partitioning, so no wide row is shuffled, however many keys repeat.

A key with more rows than a bucket has on average is hot: its rows are dealt over several slots, and so over several
buckets. A load is in the table once its keys are; loading it again replaces it, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, SLOT, LOAD, COPIES = "_key", "_slot", "_load", "_n"
_HIDDEN = {KEY, SLOT, LOAD, COPIES, "_place", "_parts"}
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


#: Rows of a bucket, all loads together: one task sorts, counts and joins so many.
ROWS, LEAST_BUCKETS = 1 << 18, 8


def buckets_for(rows: int) -> int:
    """So many buckets that one holds ROWS rows on average, however large the table is."""
    return max(LEAST_BUCKETS, -(-rows // ROWS))


@dataclass(frozen=True)
class KeyIndex:
    """`buckets` follow the rows that the table is to hold, see `buckets_for`. A key is hot beyond the rows of an average bucket, and beyond `least`."""

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    least: int = 1 << 14

    def table(self, kind: str) -> str:
        digest = hashlib.md5(f"{self.path}/{self.buckets}".encode()).hexdigest()
        return f"key_index_{digest}_{kind}"

    def location(self, kind: str) -> str:
        return f"{self.path.rstrip('/')}/{kind}_{self.buckets}"


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """One text for the values of a key; equal for equal keys only, and never NULL. Both zeros are one value."""

    def exact(name: str) -> Column:
        kind, column = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, _NESTED):
            raise ValueError(f"{name}: a key has to be a plain value")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            column = column + F.lit(0.0)
        return F.base64(column) if isinstance(kind, T.BinaryType) else column.cast("string")

    fields = [exact(name).alias(f"k{i}") for i, name in enumerate(keys)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    try:
        found = spark.read.parquet(location).schema
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return T.StructType([f for f in found if f.name != LOAD] + [T.StructField(LOAD, T.StringType())])


def _define(spark: SparkSession, index: KeyIndex, kind: str, schema: T.StructType | None = None) -> None:
    """Make the table known to the session's catalog, with the schema of its files or else of the first load."""
    name, location = index.table(kind), index.location(kind)
    if spark.catalog.tableExists(name):
        return
    found = _stored_schema(spark, location)
    if found is None and schema is None:
        raise ValueError(f"nothing was loaded into {location} yet")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in found or schema)
    spark.sql(
        f"create table {name} ({columns}) using parquet partitioned by (`{LOAD}`)"
        f" clustered by (`{SLOT}`) into {index.buckets} buckets location '{location}'"
    )
    if found is not None:
        spark.catalog.recoverPartitions(name)


def load(spark: SparkSession, index: KeyIndex, rows: DataFrame, name: str) -> None:
    """Add a load, or replace it; all loads have the columns of the first.

    `rows` is read three times (keys, their number, rows) and has to be a stored table: which slot a row of a hot key
    takes depends on its place in the file, which a repeated task finds again.
    """
    clashing = _HIDDEN & {c.lower() for c in rows.columns}
    if clashing:
        raise ValueError(f"these column names are taken: {sorted(clashing)}")
    keyed = rows.withColumn(KEY, key_text(rows, index.keys))
    total = rows.count()
    share = max(index.least, -(-total // index.buckets))
    # Fewer keys than buckets can have more rows than an average bucket, so this side is bounded.
    hot = (
        keyed.groupBy(KEY)
        .agg(F.count(F.lit(1)).alias(COPIES))
        .where(F.col(COPIES) > share)
        .select(KEY, F.ceil(F.col(COPIES) / share).alias("_parts"))
    )
    part = F.pmod("_place", "_parts").cast("string")
    dealt = (
        keyed.withColumn("_place", F.monotonically_increasing_id())
        .join(F.broadcast(hot), KEY, "left")
        .withColumn(SLOT, F.coalesce(F.concat(KEY, F.lit("#"), part), KEY))
        .select(*[F.col(f"`{c}`") for c in rows.columns], KEY, SLOT, F.lit(name).alias(LOAD))
        .repartition(index.buckets, SLOT)
    )
    _define(spark, index, "rows", dealt.schema)
    _replace(spark, index.table("rows"), name, dealt.drop(LOAD))
    stored = spark.table(index.table("rows")).where(F.col(LOAD) == name)
    counts = stored.groupBy(SLOT).agg(F.first(KEY).alias(KEY), F.count(F.lit(1)).alias(COPIES))
    counts = counts.select(SLOT, KEY, COPIES, F.lit(name).alias(LOAD))
    _define(spark, index, "keys", counts.schema)
    _replace(spark, index.table("keys"), name, counts.drop(LOAD))


def _replace(spark: SparkSession, table: str, name: str, rows: DataFrame) -> None:
    """Write a load's partition in place of what it held."""
    spark.sql(f"insert overwrite table {table} partition (`{LOAD}` = {{name}}) select * from {{rows}}", name=name, rows=rows)


def loads(spark: SparkSession, index: KeyIndex) -> list[str]:
    """The loads whose rows and keys are stored."""
    _define(spark, index, "keys")
    return sorted(r[0] for r in spark.table(index.table("keys")).select(LOAD).distinct().collect())


def repeated_slots(spark: SparkSession, index: KeyIndex) -> DataFrame:
    """(slot, copies) of the keys that more than one row has, in all loads together."""
    _define(spark, index, "keys")
    part = F.when(F.col(SLOT) != F.col(KEY), F.substring_index(SLOT, "#", -1).cast("int"))
    totals = (
        spark.table(index.table("keys"))
        .groupBy(KEY)
        .agg(F.sum(COPIES).alias(COPIES), F.coalesce(F.max(part), F.lit(-1)).alias("_last"))
        .where(F.col(COPIES) > 1)
    )
    parts = F.transform(
        F.sequence(F.lit(-1), F.col("_last")),
        lambda i: F.when(i < 0, F.col(KEY)).otherwise(F.concat(KEY, F.lit("#"), i.cast("string"))),
    )
    return totals.select(F.explode(parts).alias("_repeated"), COPIES)


def with_copies(spark: SparkSession, index: KeyIndex, name: str = "dup") -> DataFrame:
    """All rows with the number of rows that share their key; NULL is a key value like any other."""
    _define(spark, index, "rows")
    rows = spark.table(index.table("rows")).where(F.col(LOAD).isin(loads(spark, index)))
    columns = [F.col(f"`{c}`") for c in rows.columns if c not in _HIDDEN]
    # Where few keys repeat, Spark broadcasts them; where many do, they are shuffled to the buckets.
    joined = rows.join(repeated_slots(spark, index), F.col(SLOT) == F.col("_repeated"), "left")
    return joined.select(*columns, F.coalesce(F.col(COPIES), F.lit(1)).cast("long").alias(name))
