"""Batch ingestion into the bronze layer."""

from __future__ import annotations

import datetime
from collections import Counter
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagauge.config import BATCH_TABLES, INGEST_DATE, Layers
from stratagauge.functions import measures
from stratagauge.session import side_by_side

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("tabela", T.StringType()),
        T.StructField("linhas", T.LongType()),
        T.StructField("destino", T.StringType()),
    ]
)


def stamp(df: DataFrame, origin: str, kind: str = "batch") -> DataFrame:
    """Add when, from where and how the rows came in."""
    return df.withColumns(
        {
            "data_ingestao": F.current_timestamp(),
            "data_ingestao_dt": F.current_date(),
            "fonte": F.lit(origin),
            "tipo_ingestao": F.lit(kind),
        }
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers that a source delivers as NaN become NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({name: measures.number(F.col(name)).cast(types[name]) for name in floats})


def write_bronze(df: DataFrame, origin: str, path: str, fmt: str = "parquet") -> int:
    """Write one load and return its row count, counted while writing.

    Each task writes what it scanned, without a shuffle. A second load on the same day replaces the
    first; earlier days stay.
    """
    watched = Observation()
    stamped = stamp(nan_to_null(df), origin).observe(watched, F.count(F.lit(1)).alias("rows"))
    (
        stamped.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGEST_DATE)
        .save(path)
    )
    return watched.get["rows"]


def latest_load(spark: SparkSession, path: str, fmt: str = "parquet") -> datetime.date:
    """Date of the latest load: from the names of the date folders, without reading a file of any load."""
    if fmt == "delta":
        return spark.read.format(fmt).load(path).agg(F.max(INGEST_DATE)).first()[0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    dates = [name.partition("=")[2] for name in names if name.startswith(f"{INGEST_DATE}=")]
    return max(datetime.date.fromisoformat(value) for value in dates if value[:1].isdigit())


def load_files(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Ingest date -> number of data files, from the table's list of files; nothing of their content is read.

    For a table that a stream writes that is the list of committed files.
    """
    try:
        files = spark.read.format(fmt).load(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}
    mark = f"/{INGEST_DATE}="
    return dict(Counter(f.partition(mark)[2].partition("/")[0] for f in files if mark in f))


def read_bronze(
    spark: SparkSession, path: str, fmt: str = "parquet", date: datetime.date | None = None
) -> DataFrame:
    """One load of a bronze table: that of `date`, by default the latest.

    The columns are those of that load, also when earlier loads had others.
    """
    if date is None:
        date = latest_load(spark, path, fmt)
    if fmt == "delta":
        return spark.read.format(fmt).load(path).filter(F.col(INGEST_DATE) == F.lit(date))
    load = spark.read.format(fmt).option("basePath", path)
    return load.load(f"{path}/{INGEST_DATE}={date}")


def ingest(
    spark: SparkSession,
    read_source: Callable[[str], DataFrame],
    layers: Layers,
    tables: Iterable[str] = BATCH_TABLES,
) -> DataFrame:
    """Load every table into bronze; returns the report (tabela, linhas, destino)."""
    rows = side_by_side(
        {
            table: partial(write_bronze, read_source(table), table, layers.bronze(table), layers.fmt)
            for table in tables
        }
    )
    report = [(table, count, layers.bronze(table)) for table, count in rows.items()]
    return spark.createDataFrame(report, REPORT_SCHEMA)
