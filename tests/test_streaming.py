import datetime
import json

from pyspark.sql import functions as F

from stratagauge.sources.landing import land_events
from stratagauge.streaming import bronze as stream
from tests.domain import EVENT_COLUMNS, event


def drain(spark, base, **options):
    query = stream.start_bronze_stream(
        spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", "indicador-alfabetizacao", **options
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path, rows):
    base = str(tmp_path)
    events = spark.createDataFrame([event(i) for i in range(40)], EVENT_COLUMNS)
    for part in (events.filter("cast(evento_id as int) < 20"), events.filter("cast(evento_id as int) >= 20")):
        land_events(part.coalesce(1), f"{base}/in")
    query = drain(spark, base, files_per_batch=1)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2

    streamed = spark.read.parquet(f"{base}/out")
    stamped = ["fonte", "tipo_ingestao", "data_ingestao_dt"]
    assert rows(streamed.select(*stamped).distinct()) == [
        ("indicador-alfabetizacao", "streaming", datetime.datetime.now(datetime.timezone.utc).date())
    ]
    batch = stream.enrich(stream.read_events(spark, f"{base}/in", stream=False), "x")
    columns = events.columns
    assert rows(stream.good_events(streamed), *columns) == rows(stream.good_events(batch), *columns)
    assert dict(streamed.dtypes)["timestamp_evento"] == "timestamp"

    drain(spark, base)
    assert spark.read.parquet(f"{base}/out").count() == 40
    land_events(spark.createDataFrame([event(99)], EVENT_COLUMNS), f"{base}/in")
    drain(spark, base)
    assert spark.read.parquet(f"{base}/out").count() == 41


def test_bad_input_is_kept_as_text_and_does_not_stop_the_stream(spark, tmp_path):
    base = str(tmp_path)
    (tmp_path / "in").mkdir()
    good = dict(zip([c.split()[0] for c in EVENT_COLUMNS.split(",")], event("1")))
    lines = [
        json.dumps(good | {"extra": 1}),
        "not json",
        json.dumps(good | {"evento_id": "2", "ano": "abc"}),
        json.dumps(good | {"evento_id": "3", "timestamp_evento": "yesterday"}),
        json.dumps(good | {"evento_id": "4", "timestamp_evento": None}),
    ]
    (tmp_path / "in" / "eventos.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
    drain(spark, base)
    bronze = spark.read.parquet(f"{base}/out")
    assert bronze.count() == 5
    assert {r.evento_id for r in stream.good_events(bronze).collect()} == {"1", "4"}
    rejected = stream.rejected_events(bronze).collect()
    assert {r.registro_invalido for r in rejected} == {"not json", lines[2], "yesterday"}
    assert {r.motivo_quarentena for r in rejected} == {"registro_invalido"}


def test_continuous_trigger_keeps_running(spark, tmp_path):
    base = str(tmp_path)
    land_events(spark.createDataFrame([event(1)], EVENT_COLUMNS), f"{base}/in")
    query = stream.start_bronze_stream(
        spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", "x", continuous=True, interval="1 second"
    )
    try:
        query.processAllAvailable()
        land_events(spark.createDataFrame([event(2)], EVENT_COLUMNS), f"{base}/in")
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(f"{base}/out").select("evento_id").distinct().count() == 2
