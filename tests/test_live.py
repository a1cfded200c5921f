"""Deduplication, upserts and alerts on the running stream, and the versioned tables below them."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stratagauge.operators import alerts, latest
from stratagauge.sources import snapshots, upserts
from stratagauge.sources.landing import land_events
from stratagauge.streaming import bronze, live
from tests.domain import EVENT_COLUMNS, event


def at(minute):
    return (datetime.datetime(2024, 5, 1) + datetime.timedelta(minutes=minute)).isoformat()


def load(spark, base, events):
    """One file of events through the bronze stream."""
    land_events(spark.createDataFrame(events, EVENT_COLUMNS).coalesce(1), f"{base}/in")
    bronze.start_bronze_stream(spark, f"{base}/in", f"{base}/bronze", f"{base}/ckpt", "x").awaitTermination()


def stream(spark, base):
    return live.bronze_events(spark, f"{base}/bronze", spark.read.parquet(f"{base}/bronze").schema, files_per_batch=1)


def good(spark, base):
    return bronze.good_events(spark.read.parquet(f"{base}/bronze"))


def test_events_once_over_a_restart_and_late_ones_in_quarantine(spark, tmp_path):
    base = str(tmp_path)

    def drain():
        live.start_deduplicated(spark, stream(spark, base), f"{base}/live", f"{base}/live-ckpt", "10 minutes").awaitTermination()
        return spark.read.parquet(f"{base}/live")

    load(spark, base, [event(1, at(0)), event(2, at(5)), event(1, at(0)), (None, *event(0, at(1))[1:]), event(9, None)])
    drain()
    # A copy within the watermark is left out after a restart too.
    load(spark, base, [event(2, at(5)), event(3, at(60)), (None, *event(0, at(1))[1:])])
    assert sorted(r.evento_id or "" for r in drain().collect()) == ["", "", "1", "2", "3", "9"]
    # The watermark is at minute 50: event 4 is late, event 1 is a copy of one that was in time.
    load(spark, base, [event(4, at(1)), event(1, at(0)), event(5, at(55))])
    found = drain()
    assert sorted(r.evento_id or "" for r in found.collect()) == ["", "", "1", "2", "3", "5", "9"]
    late = live.late_events(good(spark, base), found).collect()
    assert [(r.evento_id, r.motivo_quarentena) for r in late] == [("4", "evento_atrasado")]


def test_latest_rows_equal_the_batch_and_repeated_batches_change_nothing(spark, tmp_path, rows):
    base, rng = str(tmp_path), random.Random(3)
    for part in range(3):
        load(spark, base, [event(part * 100 + i, at(rng.randrange(30)), str(rng.randrange(12)), float(i)) for i in range(60)])
    events = stream(spark, base)
    live.start_latest(spark, events, f"{base}/latest", f"{base}/latest-ckpt", buckets=4).awaitTermination()
    expected = rows(latest.latest_measurement(good(spark, base)))
    assert rows(upserts.read_upserts(spark, f"{base}/latest"), *good(spark, base).columns) == expected

    known = snapshots.versions(spark, f"{base}/latest")
    assert [s.version for s in known] == [2, 1, 0] and known[0].notes["stream:batch"] == "2"
    order = live.newest_first(events.columns, "timestamp_evento", "evento_id")
    again = good(spark, base).limit(5)
    assert not upserts.upsert(spark, f"{base}/latest", again, "id_municipio", order, 2, source="stream")
    assert snapshots.latest(spark, f"{base}/latest").version == 2
    # Older rows of one key: one bucket is written anew, and nothing changes in it.
    one = good(spark, base).where("id_municipio = '0000003'").union(good(spark, base).where("id_municipio = '3'")).limit(1)
    assert upserts.upsert(spark, f"{base}/latest", one, "id_municipio", order, 3, source="stream")
    before, after = snapshots.versions(spark, f"{base}/latest")[1::-1]
    assert sum(before.folders[b] != after.folders[b] for b in after.folders) == 1
    assert rows(upserts.read_upserts(spark, f"{base}/latest"), *good(spark, base).columns) == expected


def test_alerts_equal_the_batch_for_events_out_of_order(spark, tmp_path, rows):
    base, rng = str(tmp_path), random.Random(5)
    events = [event(i, at(i), str(rng.randrange(4)), rng.choice([10.0, 50.0, 90.0, None])) for i in range(200)]
    events += [event(500 + i, at(20 * i), "7", 90.0 - 40 * (i % 2)) for i in range(10)]
    events.sort(key=lambda e: (datetime.datetime.fromisoformat(e[-1]) + datetime.timedelta(minutes=rng.randrange(20)), e[0]))
    # One event that comes long after the others moves the watermark past all of them.
    for part in (events[:70], events[70:140], events[140:], [event(999, at(10_000), "99", 0.0)]):
        load(spark, base, part)
    for _ in range(2):  # the second run finds nothing new
        live.start_alerts(spark, stream(spark, base), 30, f"{base}/alerts", f"{base}/alerts-ckpt", "30 minutes").awaitTermination()
    expected = rows(alerts.drops(good(spark, base), 30, f"{base}/batch"))
    assert len(expected) > 20
    assert rows(spark.read.parquet(f"{base}/alerts"), "evento_id", "id_municipio", "timestamp_evento", "queda") == expected


def test_a_failed_write_leaves_the_version_before(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    order = [F.col("v").desc()]
    table = lambda values: spark.createDataFrame(values, "k string, v int")
    assert upserts.upsert(spark, path, table([("a", 1), ("b", 1), (None, 5)]), "k", order, 0)
    broken = table([("a", 2), ("b", 0)]).withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        upserts.upsert(spark, path, broken, "k", order, 1)
    assert rows(upserts.read_upserts(spark, path)) == [("a", 1), ("b", 1)]
    assert upserts.upsert(spark, path, table([("a", 2), ("b", 0)]), "k", order, 1)
    assert rows(upserts.read_upserts(spark, path)) == [("a", 2), ("b", 1)]
    assert upserts.upsert(spark, path, table([]), "k", order, 2)
    assert rows(upserts.read_upserts(spark, path)) == [("a", 2), ("b", 1)]


def test_vacuum_keeps_what_the_last_versions_use(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for i in range(4):
        upserts.upsert(spark, path, spark.createDataFrame([(f"k{i}", i), ("same", i)], "k string, v int"), "k", [F.col("v").desc()], i, buckets=8)
    expected = rows(upserts.read_upserts(spark, path))
    assert len(expected) == 5
    before = snapshots.versions(spark, path)[1]
    assert snapshots.vacuum(spark, path, keep=2) >= 1 and snapshots.vacuum(spark, path, keep=4) == 0
    assert rows(upserts.read_upserts(spark, path)) == expected
    assert snapshots.read(spark, path, before).count() == 4


def test_alerts_keep_no_state_for_each_key_and_repeated_batches_change_nothing(spark, tmp_path, rows):
    base = str(tmp_path)
    load(spark, base, [event(i, at(i), str(i % 3), 90.0 - 40 * (i // 3 % 2)) for i in range(30)])
    query = live.start_alerts(spark, stream(spark, base), 30, f"{base}/alerts", f"{base}/ckpt-alerts", "5 minutes")
    query.awaitTermination()
    assert query.recentProgress and not any(p["stateOperators"] for p in query.recentProgress)
    found = rows(spark.read.parquet(f"{base}/alerts"), "evento_id", "queda")
    # The watermark is at minute 24: events 3 to 5, 9 to 11, 15 to 17 and 21 to 23 fell.
    assert found == sorted((str(i), 40.0) for i in range(24) if i // 3 % 2)
    names = ("id_municipio", "timestamp_evento", "evento_id", "taxa_alfabetizacao")
    args = (30, f"{base}/alerts", f"{base}/ckpt-alerts-held", "5 minutes", "parquet", *names)
    assert not live.merge_falls(good(spark, base), 0, *args)
    late = good(spark, base).where("evento_id = '2'").withColumn("taxa_alfabetizacao", F.lit(500.0))
    assert live.merge_falls(late, 1, *args)  # behind the watermark: it changes nothing
    assert rows(spark.read.parquet(f"{base}/alerts"), "evento_id", "queda") == found
