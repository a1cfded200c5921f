"""Alerts on a falling measurement."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagauge.functions import measures

PREVIOUS, _FIRST, _LAST = "previous", "_first", "_last"


def _with_previous(key: str, value: str):
    """Arrow function for one sorted partition: the value of the row before, if of the same key."""

    def previous(column: pa.Array, carried: pa.Array) -> pa.Array:
        return pa.concat_arrays([carried, column.slice(0, len(column) - 1)])

    def extend(batch: pa.RecordBatch, carried, first: bool, last: bool) -> pa.RecordBatch:
        keys, values = batch.column(key), batch.column(value)
        same = pc.equal(keys, previous(keys, carried[0]))
        before = pc.if_else(same, previous(values, carried[1]), pa.scalar(None, values.type))
        rows = batch.num_rows
        marks = [[first] + [False] * (rows - 1), [False] * (rows - 1) + [last]]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, before, *[pa.array(mark, pa.bool_()) for mark in marks]],
            names=[*batch.schema.names, PREVIOUS, _FIRST, _LAST],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, carried, first = None, None, True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if waiting is None:
                carried = tuple(pa.nulls(1, batch.column(name).type) for name in (key, value))
            else:
                yield extend(waiting, carried, first, last=False)
                carried = tuple(waiting.column(name).slice(waiting.num_rows - 1) for name in (key, value))
                first = False
            waiting = batch
        if waiting is not None:
            yield extend(waiting, carried, first, last=True)

    return run


def previous_values(
    events: DataFrame,
    path: str,
    key: str,
    time: str,
    tie_break: str,
    value: str,
    keep: Column | None = None,
) -> DataFrame:
    """Add `previous`: the value of the same key one event earlier; only rows that meet `keep` stay.

    Rows are range-partitioned by (key, time, id), so the history of a hot key is cut into many
    partitions instead of being one window. Each partition looks back within itself; its first row
    gets the value of the partition before from the edge rows, two per partition. The rows to keep
    and the edge rows are written once to `path`, because both steps must see the same cuts: this is
    a stage, and its caller owns the folder. An event without
    key has no previous value.
    """
    order = [key, time, tie_break]
    keep = F.lit(True) if keep is None else keep
    rows = events.select(*dict.fromkeys([*order, value]))
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField(PREVIOUS, rows.schema[value].dataType),
            T.StructField(_FIRST, T.BooleanType()),
            T.StructField(_LAST, T.BooleanType()),
        ]
    )
    spark = events.sparkSession
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_with_previous(key, value), schema)
        .filter(keep | F.col(_FIRST) | F.col(_LAST))
        .write.parquet(path)
    )
    staged = spark.read.schema(schema).parquet(path)
    edges = staged.filter((F.col(_FIRST) | F.col(_LAST)) & F.col(key).isNotNull())
    window = Window.partitionBy(key).orderBy(time, tie_break)
    stitched = edges.withColumn(PREVIOUS, F.lag(value).over(window)).filter(_FIRST)
    inner = staged.filter(~F.col(_FIRST) | F.col(key).isNull())
    return inner.unionByName(stitched).filter(keep).drop(_FIRST, _LAST)


def drops(
    events: DataFrame,
    threshold: float,
    path: str,
    key: str = "id_municipio",
    time: str = "timestamp_evento",
    tie_break: str = "evento_id",
    value: str = "taxa_alfabetizacao",
) -> DataFrame:
    """Events that fell by more than `threshold` below the event before, with the size of the fall."""
    fall = F.col(PREVIOUS) - F.col(value)
    fallen = previous_values(events, path, key, time, tie_break, value, keep=fall > F.lit(threshold))
    return fallen.select(tie_break, key, time, measures.rounded(fall, 2).alias("queda"))
