"""Nearest neighbours by inner product with cross-polytope hashing.

Vectors are dealt to ranges of norms, each within a factor of two, and made unit vectors by one more coordinate,
sqrt(1 - |x|^2 / M^2) with M the largest norm of their range, so in a range the largest inner product is the nearest
direction and a single long vector squeezes no others. A query searches all ranges, those of up to FEW vectors whole. Each of TABLES tables turns them by three rounds of random signs
and a fast Hadamard transform and assigns them to the nearest signed axis. A query probes its PROBES
nearest axes in each table; every candidate there is scored exactly and the best K of all tables stay.

A key is one axis at any size of the table, so the share of the vectors that a query meets, and with it the recall, does
not fall as the table grows; the work grows with vectors times queries. Buckets are cut into blocks of BLOCK vectors
and GROUP queries, so that a large bucket is spread over many tasks; a block returns K rows for each query, never pairs.

A query that met fewer than K others (or than there are) is searched again, exactly, against all vectors in blocks.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components takes no part, neither
does a null id; ties go to the smaller id; rows that repeat an id count as one if their vectors agree
(otherwise the better score stands) and a query never finds its own id; vectors whose length differs
from the most common one take no part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratagauge.llm.common import stage, table
from stratagauge.llm.vectors import dots, matrix, usable

K, TABLES, PROBES = 20, 8, 24
BLOCK, GROUP = 2048, 512
#: Ranges of norms of up to so many vectors are searched whole; sides of a block of the exact search.
FEW, FILL = 256, 4096


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation `number` of the rows, padded to a power of two."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng(7919 + number)
    for _ in range(3):
        y *= rng.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            z = y.reshape(len(y), -1, 2, step)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], axis=2).reshape(len(y), width)
            step *= 2
        y /= np.sqrt(width)
    return y


def probes(x: np.ndarray, tables: int, n: int) -> np.ndarray:
    """Bucket keys of each row: its n best in each table, best first. Shape rows x tables x n."""
    out = []
    for t in range(tables):
        y = rotated(x, t)
        signed = np.concatenate([y, -y], axis=1)
        out.append(np.argsort(-signed, axis=1, kind="stable")[:, :n])
    return np.stack(out, axis=1)


def unit(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Rows as unit vectors of one more dimension; queries (largest None) are normalized only."""
    norms = np.sqrt((x * x).sum(1))
    if largest is None:
        return np.concatenate([x / norms[:, None], np.zeros((len(x), 1))], axis=1)
    part = x / largest
    return np.concatenate([part, np.sqrt(np.maximum(0, 1 - (part * part).sum(1)))[:, None]], axis=1)


def _hasher(largest: dict[int, float] | None, few: set[int], tables: int, n: int):
    """Rows with their keys: those of their range `r` and its largest norm, or (largest None) the probes of queries.

    Table -1 has one bucket, with all rows of the ranges `few`.
    """

    def rows(part: pa.RecordBatch, r: int, keys: np.ndarray, numbers: range) -> pa.RecordBatch:
        at = pa.array(np.repeat(np.arange(len(keys)), keys[0].size))
        number = np.broadcast_to(np.array(numbers)[None, :, None], keys.shape).ravel()
        cols = (pa.array(np.full(keys.size, r, np.int64)), pa.array(number.astype(np.int32)), pa.array(keys.ravel()))
        return pa.RecordBatch.from_arrays([*cols, *(part[c].take(at) for c in ("vec_id", "embedding"))], ["r", "t", "key", "vec_id", "embedding"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.zeros((batch.num_rows, 1, 1), np.int64)
            if largest is None:
                yield rows(batch, -1, probes(unit(matrix(batch["embedding"]), None), tables, n), range(tables))
                yield rows(batch, -1, whole, range(-1, 0))
                continue
            own = batch["r"].to_numpy()
            for r in np.unique(own).tolist():
                part = batch.filter(pa.array(own == r))
                if r in few:
                    yield rows(part, -1, whole[: len(part)], range(-1, 0))
                else:
                    yield rows(part, r, probes(unit(matrix(part["embedding"]), largest[r]), tables, n), range(tables))

    return hashed


def top(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, k: int, repeated: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of x for the query q other than its own, one for each id: ids and exact scores."""
    if repeated:
        at = np.flatnonzero(ids != own)
    else:
        near = x @ q
        cut = np.partition(near, -min(len(near), k + 1))[-min(len(near), k + 1)]
        at = np.flatnonzero((near >= cut - 1e-9 * max(1.0, abs(cut))) & (ids != own))
    score = dots(x[at], q[None, :])
    order = np.lexsort((ids[at], -score))
    if repeated:
        order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])]
    return ids[at][order[:k]], score[order[:k]]


def _search(k: int):
    def search(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            ids, x = block["vec_id"].to_numpy(), np.stack(block["embedding"].to_numpy()).astype(np.float64)
            repeated = len(np.unique(ids)) < len(ids)
            for own, q in zip(queries["vec_id"], queries["embedding"]):
                got, score = top(ids, x, np.asarray(q, np.float64), own, k, repeated)
                found.append(pd.DataFrame({"query_id": own, "vec_id": got, "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    return search


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column | str, k: int = K, tables: int = TABLES, n_probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that `is_query` holds for."""
    known = usable(vectors.select("vec_id", "embedding")).where("vec_id is not null")
    width = known.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    known = known.where(F.size("embedding") == (width["d"] if width else 1))
    known = known.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    known = stage(spark, known.withColumn("norm", norm), "vectors")
    longest = F.lit(known.agg(F.max("norm")).first()[0] or 1.0)
    # A norm so small that its square is zero has a range of its own.
    down = F.coalesce(F.log2(longest) - F.log2("norm"), F.lit(5000.0))
    known = known.withColumn("r", F.floor(F.greatest(down, F.lit(0.0))).cast("long"))
    ranges = known.groupBy("r").agg(F.count("*").alias("n"), F.max("norm").alias("m")).collect()  # at most one for each exponent of a double
    largest, few = {x["r"]: x["m"] for x in ranges}, {x["r"] for x in ranges if x["n"] <= FEW}
    schema = "r long, t int, key long, vec_id long, embedding array<double>"
    kept = known.mapInArrow(_hasher(largest, few, tables, 1), schema)
    asked = known.where(is_query).mapInArrow(_hasher(None, few, tables, n_probes), schema).drop("r")
    kept = stage(spark, kept, "table")
    sizes = kept.groupBy("r", "t", "key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    groups = asked.groupBy("t", "key").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    # A bucket of b blocks and g query groups becomes b x g tasks; rows choose their part by a hash.
    plan = sizes.join(groups, ["t", "key"])
    found = _blocks(asked.join(plan, ["t", "key"]), kept.join(plan, ["r", "t", "key"]), ["r", "t", "key"], k)
    found = stage(spark, _ranked(found, k), "found")

    ids = known.agg(F.count_distinct("vec_id")).first()[0]
    met = found.groupBy("query_id").count()
    queries = known.where(is_query)
    short = queries.select("vec_id").distinct().join(met, F.col("vec_id") == F.col("query_id"), "left")
    short = stage(spark, short.where(F.coalesce("count", F.lit(0)) < min(k, ids - 1)).select("vec_id"), "short")
    n = short.count()
    if not n:
        return found
    parts = (F.lit(-(-sum(x["n"] for x in ranges) // FILL)).alias("blocks"), F.lit(-(-n // FILL)).alias("groups"))
    again = _blocks(queries.join(short, "vec_id", "left_semi").select("*", *parts), known.select("*", *parts), [], k)
    rest = found.join(short.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti")
    return rest.unionByName(_ranked(again, k))


def _blocks(asked: DataFrame, kept: DataFrame, bucket: list[str], k: int) -> DataFrame:
    """query_id, vec_id, score: the best of each block of a bucket for each of its queries."""
    part = lambda c: F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col(c))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1))
    left = asked.select(*bucket, part("groups").alias("g"), upto("blocks").alias("b"), "vec_id", "embedding")
    right = kept.select(*bucket, upto("groups").alias("g"), part("blocks").alias("b"), "vec_id", "embedding")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, for the cogroup
    at = [*bucket, "g", "b"]
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_search(k), "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
