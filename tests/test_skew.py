"""A third of all rows has one key: adaptive execution must split its join partition."""

import os

import pytest
from pyspark.sql import functions as F

from stratagauge.operators import quality
from stratagauge.operators.joins import left_lookup, missing_in
from stratagauge.operators.latest import first_per_key
from stratagauge.operators.lookup import decode
from stratagauge.plans.catalog import QUERIES

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_thresholds(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.fixture
def hot(spark):
    return spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("payload")
    )


def split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys(small_thresholds, hot):
    for df in (hot, hot.withColumn("k", F.expr("nullif(k, -1)"))):
        counted = quality.duplicate_count(df, ["k"])
        repeated = counted.filter("dup > 1").collect()
        assert len(repeated) == 20000 and {r.dup for r in repeated} == {20000}
        assert split(counted)


def test_lookup_of_the_latest_row(small_thresholds, hot, spark):
    editions = spark.range(0, 4000, numPartitions=4).select(
        (F.col("id") % 2000 - 1).alias("key"), F.col("id").alias("edition")
    )
    latest = first_per_key(editions, ["key"], [F.desc("edition")])
    joined = left_lookup(hot, latest, {"k": "key"})
    assert joined.count() == 60000
    assert joined.filter("k = -1 and edition = 2000").count() == 20000
    assert split(joined)


def test_decoding_and_references(small_thresholds, hot, spark):
    coded = hot.withColumn("k", F.col("k").cast("string"))
    dictionary = spark.range(-1, 500).select(
        F.lit("t").alias("id_tabela"), F.lit("k").alias("nome_coluna"),
        F.col("id").cast("string").alias("chave"), F.lit("label").alias("valor"),
    )
    decoded = decode(coded, dictionary, "k", "t")
    assert decoded.filter("k_desc = 'label'").count() == 20000 + 333
    assert split(decoded)
    lost = missing_in(hot, "k", spark.range(0, 500, numPartitions=2), "id")
    assert lost.count() == 60000 - 333
    assert split(lost)


def test_a_grouping_after_the_lookup_does_not_prevent_the_split(small_thresholds, hot):
    counted = quality.duplicate_count(hot, ["k"]).groupBy("k").agg(F.sum("payload").alias("s"))
    assert split(counted)


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="test tables are not here")
@pytest.mark.parametrize("partitions", ["1", "200"])
def test_results_do_not_depend_on_the_number_of_partitions(spark, rows, partitions):
    data = "/root/testdata/sf0.001"
    names = ["target_vs_actual", "evolution", "quarantine", "latest_measurement"]
    expected = {name: rows(QUERIES[name](spark, data)) for name in names}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in names:
            assert rows(QUERIES[name](spark, data)) == expected[name], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
