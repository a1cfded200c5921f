"""Distributions, stable samples and the key filter ahead of a reference check."""

import random

import pytest
from pyspark.sql import functions as F

from stratagauge.operators import distribution, joins, sample


def gini(values):
    mean = sum(values) / len(values)
    return sum(abs(a - b) for a in values for b in values) / (2 * len(values) ** 2 * mean) if mean else None


def nearest_rank(values, percent):
    return sorted(values)[max(0, -(-len(values) * percent // 100) - 1)]


def test_distribution_equals_the_plain_version(spark, tmp_path):
    rng = random.Random(1)
    groups = {"a": [rng.randrange(1000) / 10 for _ in range(300)], "b": [5.0] * 40, "c": [0.0, 0.0], None: [1.5, 2.5, 2.5, 9.0]}
    table = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("d", None)]
    df = spark.createDataFrame(table, "g string, v double").repartition(7)
    found = {r.g: r for r in distribution.distribution(df, ["g"], "v", str(tmp_path / "p"), [10, 50, 75, 100]).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        row = found[g]
        assert row.linhas == len(values)
        assert [row.p10, row.p50, row.p75, row.p100] == [nearest_rank(values, p) for p in (10, 50, 75, 100)]
        assert row.gini == (None if g == "c" else pytest.approx(gini(values), abs=1e-6))
    assert distribution.distribution(df.limit(0), ["g"], "v", str(tmp_path / "e")).count() == 0


def test_a_hot_group_is_cut_into_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(0, 40000).select(F.lit("hot").alias("g"), ((F.col("id") * 7919) % 40000 / 10).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = distribution.distribution(df, ["g"], "v", path, [50]).first()
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert row.p50 == 1999.9 and len(sizes) == 4 and max(sizes) < 20000


def test_sketches_merge_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 5).alias("part"), ((F.col("id") * 7919) % 200_000).cast("double").alias("v"))
    merged = distribution.merge_sketches(distribution.sketches(df, ["part"], "v"), [])
    row = distribution.sketched_percentiles(merged, []).first()
    assert row.linhas == 200_000
    for percent in (10, 50, 90):
        assert abs(row[f"p{percent}"] / 200_000 - percent / 100) <= distribution.SKETCH_ERROR
    size = lambda n: len(distribution.sketches(spark.range(n).selectExpr("id as v"), [], "v").first().esboco)
    assert size(200_000) < 2 * size(20_000)


def test_samples_depend_on_the_keys_alone(spark, rows):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"), F.lit(1).alias("_place"))
    some = sample.stable_sample(df, ["k"], 5)
    assert rows(some) == rows(sample.stable_sample(df.repartition(13), ["k"], 5))
    assert set(rows(some, "k")) < set(rows(sample.stable_sample(df, ["k"], 20), "k"))
    assert 150 < some.count() < 350
    assert "Exchange" not in some._jdf.queryExecution().executedPlan().toString()
    few = sample.bottom_k(df.drop("_place"), ["s"], ["k"], 7)
    assert rows(few) == rows(sample.bottom_k(df.drop("_place").repartition(13), ["s"], ["k"], 7)) and few.count() == 21
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert sample.stable_sample(nulls, ["k"], 100).count() == 3


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_the_key_filter_changes_no_row(spark, rows, kind):
    df = spark.range(3000).select((F.col("id") % 900).cast(kind).alias("k"), F.col("id").alias("_at"))
    df = df.unionByName(spark.createDataFrame([(None, 1)], "k string, _at long").select(F.col("k").cast(kind), "_at"))
    directory = spark.range(0, 900, 7).select(F.col("id").alias("key")) if kind != "string" else spark.range(0, 900, 7).selectExpr("cast(id as string) as key")
    expected = rows(joins.missing_in(df, "k", directory, "key"))
    assert rows(joins.missing_behind_filter(df, "k", directory, "key")) == expected and len(expected) > 2000
    assert rows(joins.missing_behind_filter(df, "k", directory.limit(0), "key")) == rows(df)


def test_only_possible_hits_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100_000).select((F.col("id") * 3).alias("k"))
        found = joins.missing_behind_filter(df, "k", spark.range(0, 3000, 3).select(F.col("id").alias("key")), "key")
        assert found.count() == 99_000
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows that are missing for sure leave by a branch of their own without an exchange.
    assert "LeftAnti" in plan and "Union" in plan and plan.count("BroadcastHashJoin") >= 2
