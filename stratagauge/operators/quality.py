"""Data-quality rules: score every row once, then split into approved and quarantined rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagauge.functions import keys as key_forms
from stratagauge.functions import measures
from stratagauge.operators.joins import left_lookup

_COPIES = "_copies"
REASON_TEXT = "motivo_quarentena"
REFERENCE = "_reference"

Ranges = Mapping[str, tuple[float, float]]


@dataclass(frozen=True)
class Wording:
    """Reason texts; `{}` takes the column name."""

    # The texts that consumers of the quarantine tables filter on.
    null_key: str = "chave_nula:{}"
    duplicate_key: str = "chave_duplicada"
    out_of_range: str = "{}_fora_da_faixa"
    unknown_reference: str = "{}_sem_referencia"
    oversized_id: str = "{}_longo_demais"


DEFAULT_WORDING = Wording()


def duplicate_count(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "dup",
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add the number of rows that share the key; NULL is a key value like any other.

    Counting is a pre-aggregated group-by and only repeated keys are joined back, so a hot key is
    spread over many tasks. A window over the key would put all of its rows in one. `store` writes the
    repeated keys and reads them back: Spark then knows how few they are before it plans the join, and
    does not shuffle the wide rows to find out.
    """
    private = {key: f"_key_{i}" for i, key in enumerate(keys)}
    repeated = (
        df.groupBy(*[F.col(key).alias(alias) for key, alias in private.items()])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
    )
    repeated = repeated if store is None else store(repeated)
    joined = left_lookup(df, repeated, private, nulls_match=True)
    return joined.withColumn(name, F.coalesce(F.col("_n"), F.lit(1)).cast("long")).drop("_n")


def _row_checks(df: DataFrame, keys: Sequence[str], ranges: Ranges, wording: Wording):
    """(NULL-key checks, range checks) as columns holding the reason or NULL."""
    null_keys = [F.when(F.col(k).isNull(), F.lit(wording.null_key.format(k))) for k in keys]
    in_range = [
        F.when(~F.col(c).between(low, high), F.lit(wording.out_of_range.format(c)))
        for c, (low, high) in ranges.items()
        if c in df.columns
    ]
    return null_keys, in_range


def score(
    df: DataFrame,
    keys: Sequence[str],
    ranges: Ranges | None = None,
    wording: Wording = DEFAULT_WORDING,
    extra: Iterable[Column] = (),
    store: Callable[[DataFrame], DataFrame] | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Add `motivo_quarentena`: all reasons in rule order joined by "; ", empty for a good row.

    The order is NULL keys, repeated key, ranges, then `extra`. Bounds are inclusive and a NULL
    value is in range. `store` is that of `duplicate_count`; `counted` is a column that holds its result already.
    """
    keys = [key for key in keys if key in df.columns]
    null_keys, in_range = _row_checks(df, keys, ranges or {}, wording)
    checks = list(null_keys)
    if keys:
        df = duplicate_count(df, keys, _COPIES, store) if counted is None else df.withColumnRenamed(counted, _COPIES)
        checks.append(F.when(F.col(_COPIES) > 1, F.lit(wording.duplicate_key)))
    checks += [*in_range, *extra]
    return df.withColumn(REASON_TEXT, F.concat_ws("; ", *checks)).drop(_COPIES)


def approved(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col(REASON_TEXT) == "").drop(REASON_TEXT)


def quarantined(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col(REASON_TEXT) != "")


def evaluate(
    df: DataFrame, keys: Sequence[str], ranges: Ranges | None = None, wording: Wording = DEFAULT_WORDING
) -> tuple[DataFrame, DataFrame]:
    """(approved rows, quarantined rows with their reasons)."""
    scored = score(df, keys, ranges, wording)
    return approved(scored), quarantined(scored)


def unknown_reference(
    df: DataFrame, key: str, directory: DataFrame, wording: Wording = DEFAULT_WORDING
) -> DataFrame:
    """Add REFERENCE: the reason text where the key is set but not in the directory."""
    known = directory.groupBy(F.col(key).alias("_known")).agg(F.lit(True).alias("_found"))
    joined = left_lookup(df, known, {key: "_known"})
    lost = F.col(key).isNotNull() & F.col("_found").isNull()
    reason = F.when(lost, F.lit(wording.unknown_reference.format(key)))
    return joined.withColumn(REFERENCE, reason).drop("_found")


def oversized_id(column: str, width: int = 7, wording: Wording = DEFAULT_WORDING) -> Column:
    """Extra check for ids that are longer than their format allows."""
    return F.when(
        key_forms.oversized(F.col(column), width), F.lit(wording.oversized_id.format(column))
    )


def summary_columns(total: Column, passed: Column) -> list[Column]:
    return [
        total.alias("total"),
        passed.alias("aprovados"),
        (total - passed).alias("quarentena"),
        measures.percent(passed, total, 2).alias("pct_qualidade"),
    ]


def summary(name: str, df: DataFrame, keys: Sequence[str], ranges: Ranges | None = None) -> DataFrame:
    """One row: total, approved and quarantined rows, and the approved share.

    A row passes when its key is alone and no row check fails, so counts per key are enough: one
    pre-aggregated shuffle of the keys, without joining back to the rows.
    """
    keys = [key for key in keys if key in df.columns]
    null_keys, in_range = _row_checks(df, keys, ranges or {}, DEFAULT_WORDING)
    bad = F.coalesce(*null_keys, *in_range, F.lit(None).cast("string")).isNotNull()
    rows, failed = F.count(F.lit(1)).alias("_rows"), F.count_if(bad).alias("_failed")
    if keys:
        counts = df.groupBy(*keys).agg(rows, failed)
        passes = F.when((F.col("_rows") == 1) & (F.col("_failed") == 0), 1).otherwise(0)
    else:
        counts = df.agg(rows, failed)
        passes = F.col("_rows") - F.col("_failed")
    totals = counts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_total"),
        F.coalesce(F.sum(passes), F.lit(0)).alias("_passed"),
    )
    return totals.select(F.lit(name).alias("tabela"), *summary_columns(F.col("_total"), F.col("_passed")))


def reason_histogram(quarantine: DataFrame) -> DataFrame:
    counts = quarantine.groupBy(REASON_TEXT).agg(F.count(F.lit(1)).alias("qtd"))
    return counts.orderBy(F.desc("qtd"), REASON_TEXT)
