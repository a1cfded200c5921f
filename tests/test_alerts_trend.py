import datetime

import pytest
from pyspark.sql import functions as F

from stratagauge.operators import alerts, trend

SCHEMA = "id_municipio string, timestamp_evento timestamp, evento_id string, taxa_alfabetizacao double"


def python_drops(data, threshold):
    found, last = set(), {}
    for city, time, number, rate in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        if city is not None:
            if city in last and last[city] - rate > threshold:
                found.add((number, round(last[city] - rate, 2)))
            last[city] = rate
    return found


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_drops_equal_a_plain_loop_with_a_hot_key(spark, partitions, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    data = [
        (None if i % 50 == 0 else "hot" if i % 3 == 0 else f"c{i % 40}",
         start + datetime.timedelta(minutes=i // 5),
         f"{i:05d}",
         float((i * 7919) % 101))
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = {(r.evento_id, r.queda) for r in alerts.drops(df, 40, str(tmp_path / 'drops')).collect()}
        looked = alerts.previous_values(df, str(tmp_path / "previous"), "id_municipio", "timestamp_evento", "evento_id", "taxa_alfabetizacao")
        assert looked.count() == 3000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert found == python_drops(data, 40) and found


def test_drops_of_an_empty_table(spark, tmp_path):
    assert alerts.drops(spark.createDataFrame([], SCHEMA), 1, str(tmp_path / "drops")).count() == 0


def test_projection_follows_the_fitted_line(spark, rows):
    df = spark.createDataFrame(
        [("a", 2020, 50.0), ("a", 2021, 51.0), ("a", 2022, 52.0), ("b", 2020, 10.0), ("b", 2020, 20.0),
         ("c", 2020, None), ("d", 2020, 1.0), ("d", 2022, 2.0)],
        "k string, ano_ref int, valor double",
    )
    assert rows(trend.project(df, ["k"], at=2030, origin=2019)) == [("a", 3, 60.0), ("d", 2, 6.0)]
    for origin in (1900, 2020, 2030):
        assert rows(trend.project(df, ["k"], at=2030, origin=origin)) == [("a", 3, 60.0), ("d", 2, 6.0)]


def test_projection_keeps_all_digits_and_survives_what_does_not_fit(spark, rows):
    df = spark.createDataFrame(
        [("a", 2020, 0.04), ("a", 2021, 0.08), ("a", 2022, 0.12), ("b", 2020, 1e9), ("b", 2021, 2e9),
         ("c", 2020, float("inf")), ("c", 2021, 1.0), ("c", 2022, 1.0), ("d", 2020, 1e30)],
        "k string, ano_ref int, valor double",
    )
    assert rows(trend.project(df, ["k"], at=2050, origin=2019)) == [("a", 3, 1.2), ("b", 2, 31e9), ("c", 2, 1.0)]
