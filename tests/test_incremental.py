"""Silver events from new loads only."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratagauge.config import STREAM_TABLE, Layers
from stratagauge.plans import incremental, silver
from stratagauge.sources import bronze, snapshots
from stratagauge.sources.tables import read_table
from stratagauge.streaming import bronze as stream
from tests.domain import EVENT_COLUMNS, event


def load(spark, layers, day, events):
    """Events appended to the bronze table under an ingest date."""
    df = spark.createDataFrame(events, EVENT_COLUMNS).withColumn("_corrupt_record", F.lit(None).cast("string"))
    stamped = stream.enrich(df, "x").withColumn("data_ingestao_dt", F.lit(datetime.date(2024, 6, day)))
    stamped.coalesce(1).write.mode("append").partitionBy("data_ingestao_dt").parquet(layers.bronze(STREAM_TABLE))


def rebuilt(spark, layers):
    return silver.stream_events(spark.read.parquet(layers.bronze(STREAM_TABLE)))


@pytest.fixture
def layers(tmp_path):
    return Layers(str(tmp_path))


def check(spark, layers, rows):
    expected = rebuilt(spark, layers)
    found = read_table(spark, layers.silver("indicador_stream"))
    assert found.columns == expected.columns and rows(found) == rows(expected)
    rejected = read_table(spark, layers.quarantine("eventos_rejeitados"))
    wanted = stream.rejected_events(spark.read.parquet(layers.bronze(STREAM_TABLE)))
    assert rows(rejected, "evento_id", "registro_invalido") == rows(wanted, "evento_id", "registro_invalido")


def test_loads_are_merged_one_by_one(spark, layers, rows):
    assert incremental.update_events(spark, layers) == {"loads": 0, "rows": 0, "rejected": 0}
    nameless = (None, *event(0, "2024-05-01T09:00:00")[1:])
    load(spark, layers, 1, [event(i) for i in range(30)] + [nameless, nameless, event(99, "bad time")])
    assert incremental.update_events(spark, layers, buckets=4) == {"loads": 1, "rows": 33, "rejected": 1}
    check(spark, layers, rows)
    # A later copy, an earlier one and an equal one; a second load of rejected and nameless rows.
    load(spark, layers, 2, [event(1, "2024-05-03T10:00:00"), event(2, "2024-04-01T10:00:00"), event(3), event(50), nameless, event(98, "worse")])
    assert incremental.update_events(spark, layers) == {"loads": 1, "rows": 6, "rejected": 1}
    check(spark, layers, rows)
    # A load that has grown is read again and repeats nothing.
    load(spark, layers, 2, [event(51), nameless])
    assert incremental.pending(spark, layers) == {"2024-06-02": 2}
    assert incremental.update_events(spark, layers) == {"loads": 1, "rows": 8, "rejected": 1}
    check(spark, layers, rows)
    assert incremental.update_events(spark, layers)["loads"] == 0


def test_a_third_load_reads_one_date_and_adds_without_rewriting(spark, layers, rows):
    for day in (1, 2, 3):
        load(spark, layers, day, [event(100 * day + i) for i in range(20)])
        if day < 3:
            incremental.update_events(spark, layers, buckets=4)
    todo = incremental.pending(spark, layers)
    assert list(todo) == ["2024-06-03"]
    plan = incremental.new_rows(spark, layers, list(todo))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_ingestao_dt" in plan and "2024-06-03" in plan and "2024-06-02" not in plan
    assert incremental.update_events(spark, layers)["rows"] == 20
    check(spark, layers, rows)
    last, before = snapshots.versions(spark, layers.silver("indicador_stream"))[:2]
    assert all(last.folders[b][: len(found)] == found for b, found in before.folders.items())


def test_a_failed_update_is_done_again(spark, layers, rows, monkeypatch):
    load(spark, layers, 1, [event(i) for i in range(10)])
    incremental.update_events(spark, layers, buckets=2)
    load(spark, layers, 2, [event(i, "2024-05-09T10:00:00") for i in range(5, 15)] + [event(77, "bad")])
    real = snapshots.commit

    def dies(spark, path, snapshot):
        if path.endswith("indicador_stream"):
            raise RuntimeError("killed")
        real(spark, path, snapshot)

    monkeypatch.setattr(snapshots, "commit", dies)
    with pytest.raises(RuntimeError):
        incremental.update_events(spark, layers)
    monkeypatch.undo()
    assert read_table(spark, layers.silver("indicador_stream")).count() == 10
    assert incremental.update_events(spark, layers)["loads"] == 1
    check(spark, layers, rows)


def test_loads_are_listed_from_file_names(spark, layers):
    assert bronze.load_files(spark, layers.bronze(STREAM_TABLE)) == {}
    load(spark, layers, 1, [event(1)])
    load(spark, layers, 1, [event(2)])
    load(spark, layers, 4, [event(3)])
    assert bronze.load_files(spark, layers.bronze(STREAM_TABLE)) == {"2024-06-01": 2, "2024-06-04": 1}
