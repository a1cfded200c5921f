"""Key counts that are kept with a table, against counting again."""

import re

import pytest
from pyspark.sql import functions as F

from stratagauge.operators import quality
from stratagauge.plans.catalog import LINE_KEYS, QUERIES
from stratagauge.sources import keyindex
from stratagauge.sources.keyindex import KeyIndex

SCHEMA = "k string, ano int, v long, extra string"


def stored(spark, tmp_path, name, df):
    path = str(tmp_path / name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def some_rows(spark, first, last, every):
    """Keys that repeat inside and between loads; a third of all rows has one key, another part none."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 7 == 0, None).otherwise((i % every).cast("string"))
    return spark.range(first, last).select(
        key.alias("k"), (2000 + i % 2).cast("int").alias("ano"), i.alias("v"), F.repeat(F.lit("x"), 50).alias("extra")
    )


@pytest.mark.parametrize("every", [5, 100000])
def test_copies_equal_those_counted_again(spark, tmp_path, rows, every):
    loads = [stored(spark, tmp_path, f"in{n}", some_rows(spark, a, b, every)) for n, (a, b) in enumerate([(0, 2000), (1500, 4000)])]
    index = KeyIndex(str(tmp_path / "table"), ("k", "ano"), buckets=4, least=100)
    for n, df in enumerate(loads):
        keyindex.load(spark, index, df, f"day{n}")
    expected = rows(quality.duplicate_count(loads[0].unionByName(loads[1]), ["k", "ano"]))
    assert rows(keyindex.with_copies(spark, index)) == expected
    keyindex.load(spark, index, loads[1], "day1")
    assert rows(keyindex.with_copies(spark, index)) == expected
    assert keyindex.loads(spark, index) == ["day0", "day1"]
    for kind in ("rows", "keys"):
        spark.sql(f"drop table {index.table(kind)}")
    assert rows(keyindex.with_copies(spark, index)) == expected


def test_a_hot_key_is_dealt_over_buckets(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "table"), ("k",), buckets=8, least=50)
    keyindex.load(spark, index, stored(spark, tmp_path, "in", some_rows(spark, 0, 6000, 100000)), "a")
    table = spark.table(index.table("rows"))
    hot = table.where("k = 'hot'")
    assert hot.count() == 2000 and hot.select("_slot").distinct().count() == 3
    assert table.where("k is null").select("_slot").distinct().count() >= 1


@pytest.mark.parametrize(("every", "threshold"), [(5, "-1"), (100000, "-1"), (5, "10MB"), (100000, "10MB")])
def test_wide_rows_are_not_shuffled(spark, tmp_path, every, threshold):
    index = KeyIndex(str(tmp_path / "table"), ("k", "ano"), buckets=8, least=100)
    keyindex.load(spark, index, stored(spark, tmp_path, "in", some_rows(spark, 0, 3000, every)), "a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.shuffle.partitions", 50)  # more than there are buckets
    try:
        df = keyindex.with_copies(spark, index)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert "extra" in plan
    # The tree prints what feeds an exchange below it, one level deeper.
    for final in plan.split("== Initial Plan =="):
        lines = final.splitlines()
        for at, line in enumerate(lines):
            if not re.search(r"\bExchange\b", line):
                continue
            depth = re.search(r"[A-Z]", line).start()
            for below in lines[at + 1 :]:
                mark = re.search(r"[A-Z]", below)
                if mark is None or mark.start() <= depth:
                    break
                assert "extra" not in below, below


def test_odd_keys(spark, tmp_path, rows):
    values = [("a", 1, 1, None), ("a", 1, 2, None), (None, None, 3, ""), (None, None, 4, ""), ("", None, 5, "#0"), ("null", None, 6, "x")]
    df = stored(spark, tmp_path, "in", spark.createDataFrame(values, SCHEMA))
    index = KeyIndex(str(tmp_path / "table"), ("k", "ano"), buckets=2)
    keyindex.load(spark, index, df, "a load/with=signs")
    assert rows(keyindex.with_copies(spark, index), "v", "dup") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 1), (6, 1)]
    times = spark.sql(
        "select timestamp'2020-01-01 00:00:00.000001' as t, double('-0.0') as d, x'ff' as b union all"
        " select timestamp'2020-01-01 00:00:00.000002', double('0.0'), x'fe' union all"
        " select timestamp'2020-01-01 00:00:00.000002', double('0.0'), x'fe'"
    )
    texts = times.select(keyindex.key_text(times, ["t"]).alias("t"), keyindex.key_text(times, ["d"]).alias("d"), keyindex.key_text(times, ["b"]).alias("b"))
    assert [texts.select(c).distinct().count() for c in "tdb"] == [2, 1, 2]


def test_empty_loads_and_taken_names(spark, tmp_path, rows):
    index = KeyIndex(str(tmp_path / "table"), ("k",), buckets=2)
    empty = stored(spark, tmp_path, "in", spark.createDataFrame([], SCHEMA))
    keyindex.load(spark, index, empty, "none")
    assert keyindex.with_copies(spark, index).count() == 0
    one = stored(spark, tmp_path, "one", spark.createDataFrame([("a", 1, 1, "x")], SCHEMA))
    keyindex.load(spark, index, one, "one")
    assert rows(keyindex.with_copies(spark, index), "k", "dup") == [("a", 1)]
    with pytest.raises(ValueError, match="taken"):
        keyindex.load(spark, index, one.withColumn("_slot", F.lit(1)), "two")
    with pytest.raises(ValueError, match="plain value"):
        keyindex.key_text(one.withColumn("k", F.array("k")), ["k"])


def test_buckets_follow_the_rows(spark, tmp_path, rows, monkeypatch):
    i = F.col("id")
    lines = spark.range(900).select(
        (i % 700).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), i.alias("l_partkey"), i.alias("l_suppkey"),
        F.to_timestamp(F.concat(1992 + i % 8, F.lit("-01-01"))).alias("l_shipdate"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    seen, copies = [], keyindex.with_copies
    monkeypatch.setattr(keyindex, "with_copies", lambda spark, index: seen.append(index.buckets) or copies(spark, index))
    monkeypatch.setattr(keyindex, "ROWS", 50)
    assert keyindex.buckets_for(0) == keyindex.buckets_for(400) == 8
    found = rows(QUERIES["indexed_duplicates"](spark, str(tmp_path)))
    assert seen == [18]
    assert found == rows(quality.duplicate_count(lines, LINE_KEYS).drop("l_shipdate"))
