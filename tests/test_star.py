"""The test tables as indicator tables, from sums that are stored once."""

import datetime

from stratagauge.plans.star import Star

LINES = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


def test_sources_read_stored_sums_instead_of_line_items(spark, tmp_path, rows):
    lines = [(i, 1, i % 4, float(i % 50), 100.25 + i, i % 10 / 100, "ANR"[i % 3], "FO"[i % 2], datetime.datetime(1996 + i % 3, 5, 1)) for i in range(200)]
    lines += [(900, 1, None, 1.0, None, None, None, None, None)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(4)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    star = Star(spark, str(tmp_path))
    expected = star.source_tables()
    sources = star.stored_sums(f"{tmp_path}/sums").source_tables()
    for name, df in expected.items():
        assert sources[name].schema.simpleString() == df.schema.simpleString()
        assert rows(sources[name]) == rows(df), name
        plan = sources[name]._jdf.queryExecution().optimizedPlan().toString()
        assert name == "alunos" or "l_quantity" not in plan
