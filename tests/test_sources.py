import datetime

import pytest
from pyspark.sql import functions as F

from stratagauge.config import BATCH_TABLES, Layers
from stratagauge.sources import snapshots, bronze, landing, tables, warehouse
from tests.domain import source_tables


def test_scan_reads_only_the_asked_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") * 2).alias("x"), F.lit("y").alias("y")).write.parquet(path)
    df = tables.scan(spark, path, columns=["x"], limit=7)
    assert df.columns == ["x"] and df.count() == 7
    plan = tables.scan(spark, path, columns=["x"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan


def test_bronze_load_is_stamped_counted_and_repeatable(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1.5), (2, float("nan"))], "k int, v double")
    for _ in range(2):
        assert bronze.write_bronze(df, "origem", path) == 2
    back = bronze.read_bronze(spark, path)
    assert rows(back, "k", "v", "fonte", "tipo_ingestao") == [
        (1, 1.5, "origem", "batch"), (2, None, "origem", "batch"),
    ]
    assert back.filter("data_ingestao is null or data_ingestao_dt is null").count() == 0


def test_bronze_keeps_the_history_and_reads_the_latest_load(spark, tmp_path):
    path = str(tmp_path / "t")
    earlier = bronze.stamp(spark.range(3), "t").withColumn("data_ingestao_dt", F.lit("2020-01-01").cast("date"))
    earlier.write.partitionBy("data_ingestao_dt").parquet(path)
    bronze.write_bronze(spark.range(5), "t", path)
    assert spark.read.parquet(path).count() == 8
    assert bronze.read_bronze(spark, path).count() == 5
    old = bronze.read_bronze(spark, path, date=datetime.date(2020, 1, 1))
    assert old.count() == 3
    assert old.columns == bronze.read_bronze(spark, path).columns
    bronze.write_bronze(spark.range(5).withColumn("novo", F.lit("x")), "t", path)
    assert "novo" in bronze.read_bronze(spark, path).columns
    assert "novo" not in bronze.read_bronze(spark, path, date=datetime.date(2020, 1, 1)).columns


def test_ingest_reports_each_table(spark, tmp_path, rows):
    source = source_tables(spark)
    report = bronze.ingest(spark, source.__getitem__, Layers(str(tmp_path)))
    assert report.columns == ["tabela", "linhas", "destino"]
    assert {r.tabela: r.linhas for r in report.collect()} == {t: source[t].count() for t in BATCH_TABLES}


def test_layer_table_round_trip_with_code_like_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "01"), (2, "02"), (3, "02"), (4, None)], "v int, rede string")
    assert tables.write_table(df, path, partition="rede")["rows"] == 4
    back = tables.read_table(spark, path)
    assert rows(back) == rows(df) and back.dtypes == df.dtypes
    pruned = back.filter(F.col("rede") == "02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rede" in pruned


@pytest.mark.parametrize("partition", [None, "ano", "missing"])
def test_an_empty_table_keeps_its_schema(spark, tmp_path, partition):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([], "id string, ano int, valor double")
    assert tables.write_table(df, path, partition=partition)["rows"] == 0
    back = tables.read_table(spark, path)
    assert back.dtypes == df.dtypes and back.count() == 0


def test_replacing_a_table_drops_vanished_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("ano", (F.col("id") % 2 + 2023).cast("int"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.write_table(df, path, partition="ano")
        tables.write_table(df.filter("ano = 2024").withColumn("novo", F.lit(1)), path, partition="ano")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    back = tables.read_table(spark, path)
    assert back.select("ano").distinct().count() == 1 and "novo" in back.columns


def test_a_large_partition_value_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(0, 200000, numPartitions=8).withColumn("ano", F.lit(2024))
        tables.write_table(df, path, partition="ano")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t").rglob("ano=2024/*.parquet"))
    assert len(files) > 3


def test_landed_events_keep_microseconds(spark, tmp_path, rows):
    path = str(tmp_path / "landing")
    time = datetime.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([("1", time)], "evento_id string, t timestamp")
    landing.land_events(df, path)
    landing.land_events(df.withColumn("evento_id", F.lit("2")), path)
    back = spark.read.schema("evento_id string, t string").json(path)
    assert rows(back.withColumn("t", F.col("t").cast("timestamp"))) == [("1", time), ("2", time)]


def test_publish_replaces_tables_and_reports_counts(spark, tmp_path):
    target = str(tmp_path) + "/{}"
    for n in (5, 3):
        report = warehouse.publish(spark, {"a": spark.range(n), "b": spark.range(0)}, target)
        assert {r.tabela: r.linhas for r in report.collect()} == {"a": n, "b": 0}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3
    assert spark.read.parquet(str(tmp_path / "b")).columns == ["id"]


def test_jdbc_reads_are_parallel_or_asked_for():
    parts = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    assert tables.jdbc_options("a.b", parts) == {"dbtable": "a.b"}
    assert tables.jdbc_options("a.b", {"numPartitions": "1"}) == {"dbtable": "a.b"}
    assert tables.jdbc_options("a.b", {**parts, "query": "select 1"}) == {}
    with pytest.raises(ValueError):
        tables.jdbc_options("a.b", {"url": "x"})


def test_latest_load_comes_from_folder_names(spark, tmp_path):
    for day in ("2024-01-30", "2024-02-01", "2023-12-31"):
        spark.range(1).selectExpr(f"'{day}' as day").write.parquet(f"{tmp_path}/data_ingestao_dt={day}")
    assert str(bronze.latest_load(spark, str(tmp_path))) == "2024-02-01"
    assert [r.day for r in bronze.read_bronze(spark, str(tmp_path)).collect()] == ["2024-02-01"]


def test_a_write_that_fails_leaves_the_table_and_its_schema(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.range(6).selectExpr("id", "cast(2023 + id % 2 as int) as ano")
    tables.write_table(df, path, partition="ano")
    reader = tables.read_table(spark, path)
    other = df.selectExpr("id", "ano", "if(id = 5, raise_error('killed'), 1) as novo")
    with pytest.raises(Exception, match="killed"):
        tables.write_table(other, path, partition="ano")
    assert rows(tables.read_table(spark, path)) == rows(df) and tables.read_table(spark, path).columns == ["id", "ano"]
    tables.write_table(df.limit(0).withColumn("novo", F.lit("x")), path, partition="ano")
    assert tables.read_table(spark, path).columns == ["id", "ano", "novo"] and tables.read_table(spark, path).count() == 0
    # A reader of the version before goes on.
    assert rows(reader) == rows(df)


def test_old_versions_of_a_table_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        tables.write_table(spark.range(n), path)
    assert tables.read_table(spark, path).count() == 4
    known = snapshots.versions(spark, path)
    assert [s.version for s in known] == [3, 2, 1, 0]
    assert [snapshots.read(spark, path, s).count() for s in known] == [4, 3, 0, 0]
