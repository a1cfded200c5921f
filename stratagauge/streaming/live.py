"""Silver and gold of the event stream while it runs: one row per event, latest value per key, alerts.

All three read the bronze table as a stream, so a restart goes on where the last run stopped. State is kept in
RocksDB on the executors' disks and in the checkpoint, or in versioned tables, not in their heaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratagauge.operators import alerts
from stratagauge.operators.joins import missing_in
from stratagauge.operators.latest import first_per_key
from stratagauge.sources import snapshots
from stratagauge.sources.snapshots import Snapshot
from stratagauge.sources.upserts import BUCKETS, upsert
from stratagauge.streaming.bronze import REJECTED

# Fixed value: the reason of events that came after the watermark.
LATE = "evento_atrasado"
#: Partition column of the alerts: the number of the batch that found them. Marks the last passed event of a key.
BATCH, PASSED = "lote", "_passed"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def bronze_events(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Readable bronze events as a stream; `schema` is that of the bronze table."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).filter(F.col(REJECTED).isNull()).drop(REJECTED)


def _trigger(continuous: bool, interval: str) -> dict:
    return {"processingTime": interval} if continuous else {"availableNow": True}


def with_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, unless the session's owner chose another provider."""
    if not spark.sparkContext.getConf().contains(_PROVIDER):
        spark.conf.set(_PROVIDER, ROCKSDB)


def start_deduplicated(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    key: str = "evento_id",
    time: str = "timestamp_evento",
    fmt: str = "parquet",
    continuous: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Append each event once: the first copy that comes, while copies are no further apart than `delay`.

    An id is forgotten when the watermark has passed its event time by `delay`. Events that come after the watermark
    are left out here; `late_events` finds those of which no copy came in time. Events without id or time are no copies
    of anything and pass.
    """
    with_rocksdb(spark)
    whole = F.col(key).isNotNull() & F.col(time).isNotNull()
    once = events.filter(whole).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    # The others have no watermark of their own: the lowest of all watermarks would hold for the whole query.
    kept = once.unionByName(events.filter(~whole))
    writer = kept.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(continuous, interval)).start(path)


def late_events(bronze: DataFrame, live: DataFrame, key: str = "evento_id", reason_name: str = "motivo_quarentena") -> DataFrame:
    """Events of which every copy came after the watermark, for the quarantine; one row for each copy."""
    return missing_in(bronze.filter(F.col(key).isNotNull()), key, live).withColumn(reason_name, F.lit(LATE))


def newest_first(columns: list[str], time: str, tie_break: str) -> list[Column]:
    """A total order: the latest event, the higher id, then the higher other values."""
    rest = [name for name in columns if name not in (time, tie_break)]
    return [F.col(name).desc_nulls_last() for name in (time, tie_break, *rest)]


def start_latest(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "id_municipio",
    time: str = "timestamp_evento",
    tie_break: str = "evento_id",
    buckets: int = BUCKETS,
    continuous: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep the latest event of every key, merged batch by batch; late and repeated events need no special care."""
    order = newest_first(events.columns, time, tie_break)

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, path, batch, key, order, number, source="stream", buckets=buckets)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(continuous, interval)).start()


def _micros(spark: SparkSession, delay: str) -> int:
    return spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.lit(delay).cast("interval"))).first()[0]


def _emptied(df: DataFrame, folder: str) -> None:
    """What was written beside a table is not needed any more."""
    df.limit(0).coalesce(1).write.mode("overwrite").parquet(folder)


def merge_falls(
    batch: DataFrame,
    number: int,
    threshold: float,
    path: str,
    held: str,
    delay: str,
    fmt: str,
    key: str,
    time: str,
    tie_break: str,
    value: str,
) -> bool:
    """One batch of events: write the alerts that are certain now, keep what later batches need.

    `held` is a versioned table of the events that the watermark has not passed and, marked, of the last passed event of
    each key; its notes have the batch and the watermark. Passed events are looked back along as in `alerts.previous_values`,
    all keys in one sort that may spill, a hot key over many tasks. A batch that was merged before is left out (False);
    one that failed in between writes its folder of alerts anew.
    """
    spark, names = batch.sparkSession, (key, time, tie_break, value)
    before = snapshots.latest(spark, held)
    if before is not None and int(before.notes["batch"]) >= number:
        return False
    at, number_ = F.col(time).cast("timestamp"), F.col(value).cast("double")
    rows = batch.select(key, at.alias(time), tie_break, F.when(~F.isnan(number_), number_).alias(value), F.lit(False).alias(PASSED))
    late = F.lit(False)
    mark = None if before is None else before.notes["watermark"]
    if mark:
        late = F.unix_micros(time) <= int(mark)
    rows = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull() & ~late)
    version = 0 if before is None else before.version + 1
    aside = [snapshots.location(held, f"{kind}/{snapshots.new_folder(version)}") for kind in ("incoming", "staged")]
    rows.write.parquet(aside[0])
    new = spark.read.schema(rows.schema).parquet(aside[0])
    # In milliseconds, as the watermarks of Spark.
    newest = new.agg(F.max(F.unix_micros(time))).first()[0]
    marks = ([int(mark)] if mark else []) + ([newest // 1000 * 1000 - _micros(spark, delay)] if newest is not None else [])
    reached = max(marks, default=None)

    known = new if before is None else new.unionByName(snapshots.read(spark, held, before))
    due = F.lit(False) if reached is None else F.unix_micros(time) < reached
    passed = known.where(F.col(PASSED) | due)
    fall = F.col(alerts.PREVIOUS) - F.col(value)
    fallen = alerts.previous_values(passed, aside[1], key, time, tie_break, value, keep=fall > F.lit(threshold))
    found = fallen.select(tie_break, key, time, (F.round(fall, 2) + F.lit(0.0)).alias("queda"))
    if fmt == "delta":
        dealt = found.withColumn(BATCH, F.lit(number)).write.format(fmt).partitionBy(BATCH)
        dealt.mode("overwrite").option("replaceWhere", f"{BATCH} = {number}").save(path)
    else:
        found.write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={number}")

    last = first_per_key(passed, [key], [F.col(name).desc_nulls_last() for name in (time, tie_break, value)])
    kept = known.where(~(F.col(PASSED) | due)).unionByName(last.withColumn(PASSED, F.lit(True)))
    folder = snapshots.new_folder(version)
    kept.write.parquet(snapshots.location(held, folder))
    notes = {"batch": str(number), "watermark": "" if reached is None else str(reached)}
    snapshots.commit(spark, held, Snapshot(version, {snapshots.WHOLE: (folder,)}, kept.schema, notes=notes))
    for folder in aside:
        _emptied(new, folder)
    if version >= 2:
        snapshots.vacuum(spark, held, 2)
    return True


def start_alerts(
    spark: SparkSession,
    events: DataFrame,
    threshold: float,
    path: str,
    checkpoint: str,
    delay: str,
    fmt: str = "parquet",
    continuous: bool = False,
    interval: str = "10 seconds",
    key: str = "id_municipio",
    time: str = "timestamp_evento",
    tie_break: str = "evento_id",
    value: str = "taxa_alfabetizacao",
) -> StreamingQuery:
    """Append alerts (id, key, time, queda) to a table while events come in: events that fell by more than `threshold`.

    An event waits until the watermark has passed it: then nothing older can come, and it is compared with the event
    before of its key. The alerts equal the batch alerts for all events that come before the watermark. Events without key or
    time have no place in an order and give no alert. The events that wait lie beside the checkpoint.
    """
    names = (key, time, tie_break, value)
    held = f"{checkpoint.rstrip('/')}-held"
    begun = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if begun.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(begun):
        raise ValueError(f"{path} was begun with state in its checkpoint, whose events are not read here: give a new path and checkpoint")

    def merge(batch: DataFrame, number: int) -> None:
        merge_falls(batch, number, threshold, path, held, delay, fmt, *names)

    writer = events.select(*dict.fromkeys(names)).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(continuous, interval)).start()
