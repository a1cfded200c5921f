"""Tables that keep one row per key and take new rows batch by batch.

Rows lie in hash buckets of their key, and versions of the table share the buckets that a batch does not touch.
A batch that was merged before is not merged again, so a stream that repeats a batch after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.operators.latest import first_per_key
from stratagauge.sources import snapshots
from stratagauge.sources.snapshots import BUCKET, Snapshot

#: Hash buckets of a new table; about 1 GB of rows in each is a good size. Folders of a bucket before it is rewritten.
BUCKETS, ADDED = 64, 16


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def upsert(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    key: str,
    order: Sequence[Column],
    batch: int,
    source: str = "batch",
    buckets: int = BUCKETS,
    fmt: str = "parquet",
) -> bool:
    """Merge a batch: of the stored row and the new ones of a key the first in `order` stays.

    `order` has to be total, so that the result does not depend on how rows come in batches. Batches of
    one `source` have rising numbers; returns False for one that was merged already. Only buckets with new
    rows are read and rewritten. Rows without key are left out: they are no copies of one another.
    """
    before = snapshots.latest(spark, path)
    mark = f"{source}:batch"
    if before is not None and int(before.notes.get(mark, -1)) >= batch:
        return False
    notes = dict(before.notes) if before is not None else {"buckets": str(buckets)}
    schema = before.schema if before is not None else rows.schema
    if before is None:
        before = Snapshot(-1, {}, schema, fmt, notes)
    version = before.version + 1
    # One row per key and task leaves the scan; written once, because the merge needs to know the buckets first.
    new = first_per_key(rows.select(*schema.names).where(F.col(key).isNotNull()), [key], order)
    staged = staged_rows(spark, path, new, before, key)
    folders = merged_folders(spark, path, staged, before, key, order)
    snapshots.commit(spark, path, Snapshot(version, folders, schema, fmt, notes | {mark: str(batch)}))
    return True


def staged_rows(spark: SparkSession, path: str, new: DataFrame, before: Snapshot, key: str) -> DataFrame:
    """The rows of a batch with their bucket, written beside the table and read back."""
    incoming = snapshots.location(path, f"incoming/{snapshots.new_folder(before.version + 1)}")
    dealt = new.withColumn(BUCKET, bucket_of(key, int(before.notes["buckets"])))
    dealt.write.format(before.fmt).save(incoming)
    return spark.read.format(before.fmt).schema(f"{_ddl(before.schema)}, {BUCKET} int").load(incoming)


def merged_folders(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    before: Snapshot,
    key: str,
    order: Sequence[Column],
    mostly_new: bool = False,
) -> dict[int, tuple[str, ...]]:
    """Folders of the version after `before` with the staged rows (one per key) merged in.

    With `mostly_new` the stored keys of the touched buckets are read first, and only buckets that hold one of the new
    keys are rewritten; to the others the new rows are added as another folder, until there are ADDED of them.
    """
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # no more than there are buckets
    stored = [b for b in touched if b in before.folders]
    anew = stored
    if mostly_new and stored:
        keys = snapshots.read(spark, path, before, stored).select(F.col(key).alias("_stored"))
        again = staged.join(keys, F.col(key) == F.col("_stored"), "left_semi").select(BUCKET).distinct()
        full = {b for b in stored if len(before.folders[b]) >= ADDED}
        anew = sorted(full | {r[0] for r in again.collect()})
    folders = dict(before.folders)
    if not touched:
        return folders
    bucket = bucket_of(key, int(before.notes["buckets"])).alias(BUCKET)
    rows = staged
    if anew:
        old = snapshots.read(spark, path, before, anew).select("*", bucket)
        rows = first_per_key(staged.unionByName(old), [BUCKET, key], order)
    folder = snapshots.new_folder(before.version + 1)
    rows.repartition(BUCKET).write.format(before.fmt).partitionBy(BUCKET).save(snapshots.location(path, folder))
    for b in touched:
        mine = f"{folder}/{BUCKET}={b}"
        folders[b] = (mine,) if b in anew or b not in before.folders else (*before.folders[b], mine)
    return folders


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of such a table."""
    snapshot = snapshots.latest(spark, path)
    if snapshot is None:
        raise ValueError(f"no batch was merged into {path} yet")
    return snapshots.read(spark, path, snapshot)
