"""The stages of a full run, each from the stored tables of the stage before."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.config import (
    BATCH_TABLES,
    QUALITY_SPECS,
    STREAM_ORIGIN,
    STREAM_TABLE,
    Layers,
    QualitySpec,
)
from stratagauge.operators import alerts, clean, profile, quality
from stratagauge.plans import gold, silver
from stratagauge.session import side_by_side
from stratagauge.sources import bronze, snapshots
from stratagauge.sources.tables import read_table, write_table
from stratagauge.streaming import bronze as stream

PASSED = "aprovado"

# Partition column of each gold table.
GOLD_PARTITIONS = {
    "indicador_municipio": "ano",
    "evolucao_municipio": "ano_ref",
    "indicador_uf": "ano",
    "indicador_stream_recente": None,
    "desigualdade_regional": None,
    "risco_meta": None,
    "alertas_queda": None,
}

#: Points by which a measurement has to fall below the one before to be an alert.
ALERT_POINTS = 5.0

_CHECKED_FOR_GOLD = ("municipio", "uf", "meta_municipio", "meta_uf", "indicador_stream")


def load_bronze(
    spark: SparkSession, read_source: Callable[[str], DataFrame], layers: Layers, **options
) -> DataFrame:
    """Batch tables into bronze; returns the load report."""
    return bronze.ingest(spark, read_source, layers, **options)


def drain_events(spark: SparkSession, layers: Layers, **options) -> None:
    """Landed events into bronze, until none is left."""
    stream.start_bronze_stream(
        spark,
        layers.landing,
        layers.bronze(STREAM_TABLE),
        layers.stream_checkpoint,
        STREAM_ORIGIN,
        fmt=layers.fmt,
        **options,
    ).awaitTermination()


def _bronze_reader(spark: SparkSession, layers: Layers) -> Callable[[str], DataFrame]:
    return lambda table: bronze.read_bronze(spark, layers.bronze(table), layers.fmt)


def _bronze_events(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.format(layers.fmt).load(layers.bronze(STREAM_TABLE))


def oversized_ids(spark: SparkSession, layers: Layers, tables: Iterable[str] = BATCH_TABLES) -> DataFrame:
    """Bronze rows per table whose municipality id is too long; `check_quality` quarantines them."""
    read = _bronze_reader(spark, layers)
    with_id = {table: df for table in tables if "id_municipio" in (df := read(table)).columns}
    return profile.row_counts({table: clean.oversized_ids(df) for table, df in with_id.items()})


def write_silver(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """All silver tables and the rejected events; returns the rows written per table.

    Derived tables are built from the stored cleaned ones, so nothing is cleaned twice.
    """
    lazy = silver.silver_tables(
        _bronze_reader(spark, layers), lambda: _bronze_events(spark, layers)
    )

    def write(name: str, df: DataFrame) -> Callable[[], int]:
        return lambda: write_table(df, layers.silver(name), layers.fmt, partition="ano")["rows"]

    def stored(name: str) -> DataFrame:
        return read_table(spark, layers.silver(name), layers.fmt)

    derived = {
        "taxa_alunos_calc": lambda: silver.student_rates(stored("alunos")),
        "indicador_municipio": lambda: silver.municipality_indicator(
            stored("municipio"), stored("meta_municipio")
        ),
    }
    rejected = stream.rejected_events(_bronze_events(spark, layers))
    path = layers.quarantine("eventos_rejeitados")
    rows = side_by_side({name: write(name, df) for name, df in lazy.items() if name not in derived})
    rows |= side_by_side({name: write(name, build()) for name, build in derived.items()})
    write_table(rejected, path, layers.fmt, rebalance=True)
    return rows


def check_quality(
    spark: SparkSession, layers: Layers, specs: Mapping[str, QualitySpec] = QUALITY_SPECS
) -> DataFrame:
    """Score each silver table once and store both outcomes; returns the quality report.

    The scored rows are stored by outcome, with the counts observed by the same write. The
    quarantine table, which is written even when it is empty, is copied from the failed rows.
    """

    def silver_table(name: str) -> DataFrame:
        return read_table(spark, layers.silver(name), layers.fmt)

    def check(table: str, spec: QualitySpec) -> dict[str, int]:
        rows = silver_table(table)
        extra = [quality.oversized_id("id_municipio")] if "id_municipio" in rows.columns else []
        if spec.reference is not None:
            column, directory = spec.reference
            rows = quality.unknown_reference(rows, column, silver_table(directory))
            extra.append(F.col(quality.REFERENCE))

        def store(repeated: DataFrame) -> DataFrame:
            path = f"{layers.checked(table)}_chaves_repetidas"
            write_table(repeated, path, layers.fmt)
            return read_table(spark, path, layers.fmt)

        scored = quality.score(rows, spec.keys, spec.ranges, extra=extra, store=store).drop(quality.REFERENCE)
        scored = scored.withColumn(PASSED, F.col(quality.REASON_TEXT) == "")
        path = layers.checked(table)
        seen = write_table(
            scored,
            path,
            layers.fmt,
            partition=PASSED,
            rebalance=False,
            metrics={"passed": F.count_if(F.col(PASSED))},
        )
        failed = read_table(spark, path, layers.fmt).filter(~F.col(PASSED)).drop(PASSED)
        write_table(failed, layers.quarantine(table), layers.fmt, rebalance=True)
        return seen

    seen = side_by_side({table: partial(check, table, spec) for table, spec in specs.items()})
    report = [(table, counts["rows"], counts["passed"]) for table, counts in seen.items()]
    counts = spark.createDataFrame(report, "tabela string, rows long, passed long")
    return counts.select("tabela", *quality.summary_columns(F.col("rows"), F.col("passed")))


def read_approved(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    """Rows of a silver table that passed; only their partition is read."""
    checked = read_table(spark, layers.checked(table), layers.fmt)
    return checked.filter(F.col(PASSED)).drop(PASSED, quality.REASON_TEXT)


def write_gold(spark: SparkSession, layers: Layers, only_approved: bool = True) -> dict[str, int]:
    """All gold tables from the approved silver rows; returns the rows written per table."""

    def read(table: str) -> DataFrame:
        if only_approved:
            return read_approved(spark, layers, table)
        return read_table(spark, layers.silver(table), layers.fmt)

    approved = {name: read(name) for name in _CHECKED_FOR_GOLD}
    tables = gold.gold_tables(approved)
    # Looking back along the events of a hot key takes a stage of its own.
    looked_back = snapshots.location(layers.gold("alertas_queda"), f"staged/{snapshots.new_folder(0)}")
    tables["alertas_queda"] = alerts.drops(approved["indicador_stream"], ALERT_POINTS, looked_back)

    def write(name: str) -> int:
        path, partition = layers.gold(name), GOLD_PARTITIONS[name]
        return write_table(tables[name], path, layers.fmt, partition)["rows"]

    return side_by_side({name: partial(write, name) for name in tables})


def build_gold(
    read: Callable[[str], DataFrame], read_events: Callable[[], DataFrame]
) -> dict[str, DataFrame]:
    """Silver and gold as one lazy plan over bronze tables, without stored steps, for publishing."""
    return gold.gold_tables(silver.silver_tables(read, read_events))
