"""Event stream into the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratagauge.config import INGEST_DATE
from stratagauge.sources.bronze import stamp

# The event fields, in file order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("evento_id", T.StringType()),
        T.StructField("id_municipio", T.StringType()),
        T.StructField("sigla_uf", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("rede", T.StringType()),
        T.StructField("serie", T.StringType()),
        T.StructField("taxa_alfabetizacao", T.DoubleType()),
        T.StructField("timestamp_evento", T.StringType()),
    ]
)

REJECTED = "registro_invalido"
_CORRUPT = "_corrupt_record"


def read_events(
    spark: SparkSession,
    landing: str,
    schema: T.StructType = EVENT_SCHEMA,
    files_per_batch: int = 1000,
    stream: bool = True,
) -> DataFrame:
    """Events of the landing folder, as a stream or as one batch, with the text of corrupt lines."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    return (
        reader.schema(T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(landing)
    )


def enrich(
    events: DataFrame, origin: str, time: str = "timestamp_evento", time_type: str = "timestamp"
) -> DataFrame:
    """Parse the event time and add the ingest columns.

    Bad input does not stop the stream: a corrupt line or an unreadable time is kept as text in
    `registro_invalido`, which is NULL for good rows.
    """
    parsed = F.col(time).try_cast(time_type)
    unreadable = F.when(F.col(time).isNotNull() & parsed.isNull(), F.col(time))
    return stamp(
        events.withColumn(REJECTED, F.coalesce(F.col(_CORRUPT), unreadable))
        .withColumn(time, parsed)
        .drop(_CORRUPT),
        origin,
        "streaming",
    )


def start_bronze_stream(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    origin: str,
    continuous: bool = False,
    interval: str = "10 seconds",
    files_per_batch: int = 1000,
    fmt: str = "parquet",
    schema: T.StructType = EVENT_SCHEMA,
    time: str = "timestamp_evento",
    time_type: str = "timestamp",
) -> StreamingQuery:
    """Append landed events to bronze, each exactly once, also over restarts.

    By default what has landed is drained and the query stops; `continuous` keeps it running.
    """
    events = enrich(read_events(spark, landing, schema, files_per_batch), origin, time, time_type)
    writer = (
        events.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(INGEST_DATE)
    )
    trigger = {"processingTime": interval} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def good_events(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_events(bronze: DataFrame, reason_name: str = "motivo_quarentena") -> DataFrame:
    """Rows that could not be read, with their text, for the quarantine."""
    return bronze.filter(F.col(REJECTED).isNotNull()).withColumn(reason_name, F.lit(REJECTED))
