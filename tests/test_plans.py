"""What the physical plans must and must not contain."""

import os
import re

import pytest

from stratagauge.plans.catalog import QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

# Queries that only return what an earlier write or stream has stored.
STORED = {
    "bronze_ingest", "ingest_report", "partitioned_layer", "quarantine_sink", "published_tables",
    "stream_bronze", "stream_deduplicated", "drop_alert", "gold_from_layers", "table_versions", "quality_report",
    "live_deduplicated", "live_latest", "live_alerts", "incremental_events",
    "indexed_duplicates", "indexed_quarantine",
}
# Its broadcast is a bitmap of bounded size.
BITMAP = {"filtered_violations"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(plan, table):
    schemas = re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<(.*?)>\n", plan + "\n")
    return [sorted(part.split(":")[0] for part in schema.split(",")) for schema in schemas]


@pytest.fixture
def large_tables(spark):
    """Plan as if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED - BITMAP))
def test_no_forced_broadcast_no_pairs_and_no_python(spark, large_tables, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for node in ("Broadcast", "CartesianProduct", "Python", "ArrowEval", "MapInArrow"):
        assert node not in plan, node


@pytest.mark.parametrize("name", ["approved", "duplicate_count", "quarantine", "reason_histogram", "rate_of_approved"])
def test_no_window_over_a_key_that_may_be_hot(spark, large_tables, name):
    assert "Window" not in plan_of(QUERIES[name](spark, DATA))


def test_latest_row_is_reduced_before_the_shuffle(spark):
    assert re.search(r"Exchange.*\n.*WindowGroupLimit .* Partial", plan_of(QUERIES["latest_measurement"](spark, DATA)))


def test_latest_targets_stay_where_they_were_summed(spark, large_tables):
    """Targets in long form keep the partitioning of the wide ones, so the latest edition needs no further shuffle."""
    plan = plan_of(QUERIES["latest_targets"](spark, DATA))
    assert "WindowGroupLimit" in plan.split("Generate inline")[0] and "Exchange" not in plan.split("Generate inline")[0]


@pytest.mark.parametrize("name", ["top_gap", "ordered_sample"])
def test_top_rows_are_kept_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, DATA))


def test_only_needed_columns_are_read(spark, large_tables):
    rate = ["l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate", "l_suppkey"]
    read = scanned(plan_of(QUERIES["weighted_rate"](spark, DATA)), "lineitem")
    assert read == [sorted([*rate, "l_linestatus"])]
    summary = scanned(plan_of(QUERIES["quality_summary"](spark, DATA)), "lineitem")
    assert summary == [["l_linenumber", "l_orderkey", "l_quantity", "l_shipdate"]]
    assert scanned(plan_of(QUERIES["referential_violations"](spark, DATA)), "documents") == [["doc_id"]]


def test_line_items_are_scanned_once_for_results_and_targets(spark, large_tables):
    df = QUERIES["target_vs_actual"](spark, DATA)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    reads = re.findall(r"FileScan parquet \[([^\]]*)\]", final)
    assert sum("l_quantity" in columns for columns in reads) == 1
