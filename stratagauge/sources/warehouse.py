"""Publishing result tables to a warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratagauge.session import side_by_side
from stratagauge.sources.bronze import REPORT_SCHEMA


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    location: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Truncate and load each table through the connector `fmt`; returns (tabela, linhas, destino).

    Executors write directly. `location` is a template such as `dataset.{}` or `/path/{}`; for JDBC
    it names the `dbtable`.
    """

    def load(name: str, df: DataFrame) -> int:
        target = location.format(name)
        watched = Observation()
        counted = df.observe(watched, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.format(fmt).mode("overwrite").options(**(options or {}))
        if fmt == "jdbc":
            writer.option("dbtable", target).option("truncate", "true").save()
        else:
            writer.save(target)
        return watched.get["rows"]

    rows = side_by_side({name: partial(load, name, df) for name, df in tables.items()})
    report = [(name, count, location.format(name)) for name, count in rows.items()]
    return spark.createDataFrame(report, REPORT_SCHEMA)
