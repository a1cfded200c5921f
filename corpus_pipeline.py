"""From raw documents to encoded training text: quality, line dedup, near-dedup, mixing, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm import linededup, mixing, neardup, pieces, quality
from stratagauge.llm.common import fresh, stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer accepts, with all columns as they are.

    Null texts and those without any visible character go; rows that repeat are judged alike, so all stay or all go;
    a null doc_id does not matter; an empty table stays empty.
    """
    return quality.good_documents(spark, docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which nothing is left go.

    n_chars, if there is one, follows the text; all other columns stay, whatever their names. Null and blank texts of which
    no line was removed stay, as do rows without doc_id. Rows that repeat a doc_id are told apart by their text.
    """
    removed, left = fresh(docs, "removed"), fresh(docs, "left")
    done = linededup.cut_lines(spark, docs, removed, left)
    kept = done.where((F.col(removed) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, with all columns as they are.

    The smallest doc_id stays. Different texts under one doc_id are different documents; rows without doc_id or words stay.
    """
    return neardup.unique_documents(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of their sources takes them, with all columns as they are.

    A null source is a source of its own; null texts and those without words have no size and are never taken.
    """
    return mixing.mixed_documents(spark, docs)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the piece ids of each document; null and empty texts have none, rows that repeat have equal ones."""
    return pieces.encode(spark, docs.select("doc_id", "source", "text"), pieces.load()).select("doc_id", "source", "ids", "round_trip")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_text),
]

#: Signatures, EM and merges are iterative; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(spark, docs, name)
    return docs
