"""Silver events brought up to date from the bronze loads that are new.

The silver table's own version log is the ledger: every version notes the ingest dates that are in it and
how many files each had. A run reads the dates that are missing there or have grown, splits their rows into
readable and rejected ones in one pass, and merges them; a run that fails leaves silver and ledger as they were.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratagauge.config import INGEST_DATE, STREAM_TABLE, Layers
from stratagauge.operators.clean import clean
from stratagauge.operators.latest import event_order, first_per_key
from stratagauge.sources import bronze, snapshots, upserts
from stratagauge.sources.snapshots import BUCKET, Snapshot
from stratagauge.streaming.bronze import REJECTED, good_events, rejected_events

EVENTS, REJECTS = "indicador_stream", "eventos_rejeitados"
_LEDGER, _READABLE = "loads", "_readable"


def ledger(snapshot: Snapshot | None) -> dict[str, int]:
    """Ingest date -> files of it that are in the table."""
    return json.loads(snapshot.notes.get(_LEDGER, "{}")) if snapshot is not None else {}


def pending(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """Ingest dates of bronze events that silver lacks, or that have more files by now, with their number of files."""
    known = ledger(snapshots.latest(spark, layers.silver(EVENTS)))
    found = bronze.load_files(spark, layers.bronze(STREAM_TABLE), layers.fmt)
    return {date: files for date, files in found.items() if known.get(date) != files}


def new_rows(spark: SparkSession, layers: Layers, dates: list[str]) -> DataFrame:
    """Bronze events of some ingest dates; no file of another date is read."""
    rows = spark.read.format(layers.fmt).load(layers.bronze(STREAM_TABLE))
    return rows.filter(F.col(INGEST_DATE).isin([F.lit(d).cast("date") for d in sorted(dates)]))


def _by_date(date: str) -> int:
    """A bucket for what is kept load by load; below the buckets of a hash."""
    return -int(date.replace("-", ""))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn(BUCKET, -F.date_format(INGEST_DATE, "yyyyMMdd").cast("int"))


def _replace_loads(spark: SparkSession, path: str, rows: DataFrame, before: Snapshot, dates: list[str]) -> dict:
    """Folders with the rows of these loads in place of what they had."""
    folder = snapshots.new_folder(before.version + 1)
    target = snapshots.location(path, folder)
    rows.write.format(before.fmt).partitionBy(BUCKET).save(target)
    wanted = {_by_date(date) for date in dates}
    present = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    kept = {b: found for b, found in before.folders.items() if b not in wanted}
    return kept | {b: (f"{folder}/{BUCKET}={b}",) for b in present}


def update_events(spark: SparkSession, layers: Layers, buckets: int = upserts.BUCKETS) -> dict[str, int]:
    """Merge new bronze loads into the silver events and the rejected ones; returns loads, rows read and rows rejected.

    The result equals the silver events built from all loads at once: of several copies of an event the same one
    stays, and events without id all stay, load by load, so that reading a load again does not repeat them.
    """
    todo = pending(spark, layers)
    if not todo:
        return {"loads": 0, "rows": 0, "rejected": 0}
    dates, path = sorted(todo), layers.silver(EVENTS)
    before = snapshots.latest(spark, path)
    known = ledger(before)
    # Both outcomes from one pass over the new loads.
    rows = new_rows(spark, layers, dates)
    watched = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REJECTED).isNotNull()).alias("rejected")]
    split = rows.withColumn(_READABLE, F.col(REJECTED).isNull()).observe(watched, *counts)
    incoming = snapshots.location(path, f"incoming/{snapshots.new_folder(len(known))}")
    split.write.format(layers.fmt).partitionBy(_READABLE).save(incoming)
    both = spark.read.format(layers.fmt).schema(split.schema).load(incoming)

    rejects = layers.quarantine(REJECTS)
    bad = _dated(rejected_events(both.filter(~F.col(_READABLE)).drop(_READABLE)))
    old = snapshots.latest(spark, rejects)
    if old is None or _LEDGER not in old.notes:
        old = Snapshot(old.version if old else -1, {}, bad.drop(BUCKET).schema, layers.fmt)
    folders = _replace_loads(spark, rejects, bad, old, dates)
    snapshots.commit(spark, rejects, Snapshot(old.version + 1, folders, old.schema, layers.fmt, {_LEDGER: json.dumps(known | todo)}))

    good = good_events(both.filter(_READABLE).drop(_READABLE))
    cleaned = clean(good.withColumn("_load", F.col(INGEST_DATE)))
    schema = cleaned.drop("_load").schema
    if before is None or _LEDGER not in before.notes:
        before = Snapshot(before.version if before else -1, {}, schema, layers.fmt, {"buckets": str(buckets), _LEDGER: "{}"})
    nameless = _dated(cleaned.filter("evento_id is null").withColumnRenamed("_load", INGEST_DATE)).drop(INGEST_DATE)
    order = event_order(schema.names)
    named = first_per_key(cleaned.filter("evento_id is not null").drop("_load"), ["evento_id"], order)
    staged = upserts.staged_rows(spark, path, named, before, "evento_id")
    folders = upserts.merged_folders(spark, path, staged, before, "evento_id", order, mostly_new=True)
    folders = _replace_loads(spark, path, nameless, Snapshot(before.version, folders, schema, layers.fmt), dates)
    notes = dict(before.notes) | {_LEDGER: json.dumps(known | todo)}
    snapshots.commit(spark, path, Snapshot(before.version + 1, folders, schema, layers.fmt, notes))
    return {"loads": len(dates), **watched.get}
