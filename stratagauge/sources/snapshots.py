"""Versioned tables on plain files: a job that fails leaves the version that readers see.

Every write goes to a folder of its own below `data`. One line in `_log` then makes it the current version; it
names the folders that belong to the version, its schema and notes of the writer. A reader takes the folders
of the latest line, so it never sees half of a write, and goes on reading an old version while a new one
is made. A table may be cut into hash buckets; a version then shares the folders of all buckets that a write
did not touch with the version before. One writer at a time is assumed; of two the one that commits last wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG, _DATA = "_log", "data"
VERSION, BUCKET = "snapshot_v", "snapshot_bucket"
_RECORD = "version long, folders map<string,array<string>>, schema string, fmt string, notes map<string,string>"
#: The bucket of a table that has none.
WHOLE = -1


@dataclass(frozen=True)
class Snapshot:
    """One version: the folders of each bucket (all under WHOLE if there are no buckets), schema and notes."""

    version: int
    folders: Mapping[int, tuple[str, ...]]
    schema: T.StructType
    fmt: str = "parquet"
    notes: Mapping[str, str] = field(default_factory=dict)


def _records(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_RECORD).json(f"{path}/{_LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _snapshot(row) -> Snapshot:
    folders = {int(bucket): tuple(found) for bucket, found in row.folders.items()}
    return Snapshot(row.version, folders, T.StructType.fromJson(json.loads(row.schema)), row.fmt, row.notes or {})


def latest(spark: SparkSession, path: str) -> Snapshot | None:
    """The current version, None if nothing was committed yet."""
    records = _records(spark, path)
    row = None if records is None else records.orderBy(F.desc("version")).first()
    return None if row is None else _snapshot(row)


def new_folder(version: int) -> str:
    """Name of a folder for the data of a version; a failed attempt's folder is never used again."""
    return f"{VERSION}=v{version}-{uuid.uuid4().hex[:8]}"


def location(path: str, folder: str) -> str:
    return f"{path}/{_DATA}/{folder}"


def commit(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Make a version the current one: one file appears in the log, or none does."""
    folders = {str(bucket): list(found) for bucket, found in snapshot.folders.items()}
    row = (snapshot.version, folders, snapshot.schema.json(), snapshot.fmt, dict(snapshot.notes))
    spark.createDataFrame([row], _RECORD).coalesce(1).write.mode("append").json(f"{path}/{_LOG}")


def read(spark: SparkSession, path: str, snapshot: Snapshot, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets."""
    folders = [f for b, found in snapshot.folders.items() if buckets is None or b in buckets for f in found]
    if not folders:
        return spark.createDataFrame([], snapshot.schema)
    reader = spark.read.format(snapshot.fmt).schema(snapshot.schema).option("basePath", f"{path}/{_DATA}")
    return reader.load([location(path, folder) for folder in folders]).select(*snapshot.schema.names)


def versions(spark: SparkSession, path: str) -> list[Snapshot]:
    """All versions in the log, the latest first."""
    records = _records(spark, path)
    return [] if records is None else [_snapshot(r) for r in records.orderBy(F.desc("version")).collect()]


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Empty the folders that only versions before the last `keep` name; returns how many folders that are.

    Versions that were vacuumed can no longer be read.
    """
    known = versions(spark, path)
    used = {f for s in known[:keep] for found in s.folders.values() for f in found}
    old = {f: s for s in known[keep:] for found in s.folders.values() for f in found if f not in used}
    for folder, snapshot in old.items():
        empty = spark.createDataFrame([], snapshot.schema)
        empty.coalesce(1).write.format(snapshot.fmt).mode("overwrite").save(location(path, folder))
    return len(old)
