"""Near-duplicate embeddings by NN-descent.

1. Equal vectors of a label become one node that remembers how many they are.
2. Each node gets first neighbours: its successors in SORTS orders by random-hyperplane signs.
3. Rounds of NN-descent: at each node the neighbours (both directions) are compared with one another,
   and each keeps its K best. Rounds go on until few list entries change.
4. Neighbours at `threshold` or more are links; they form components. Where lists are saturated with links, a
   list of K cannot hold them all: lists are enlarged to the whole component and its inner links
   are counted exactly in blocks.
5. An audit compares parts of the nodes with all nodes until LINKED nodes with links were seen, or all nodes; below
   RECALL, K doubles and the rounds go on. If that does not help, all nodes of a label are compared in blocks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null
label, link with nothing and are components of their own; vectors of different length do not link; rows
that repeat a vec_id with the same vector count as one other vector and get a row each; a null vec_id has no links, a
null component and is not kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratagauge.llm.common import components, spanning, stage, table
from stratagauge.llm.vectors import matrix, usable

THRESHOLD, K, ROUNDS, SORTS, AHEAD = 0.93, 10, 6, 8, 4
#: Share of list entries that may still change when the rounds end; audited recall.
SETTLED, RECALL = 0.01, 0.99
#: Nodes audited at a time; how many with links end the audit.
AUDITED, LINKED = 2048, 128
#: Nodes of a component that are compared at a time; of a label, where all are.
BLOCK, ALL = 512, 2048

EDGE = "a long, b long, s double"


def nodes(vectors: DataFrame) -> DataFrame:
    """id (smallest vec_id of equal vectors), label, width, n (how many), v (unit vector)."""
    known = usable(vectors.select("vec_id", "label", "embedding")).where("label is not null and vec_id is not null")
    known = known.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e")).distinct()
    per = known.groupBy("label", "e").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    per = per.withColumn("m", F.array_max(F.transform("e", F.abs))).withColumn("e", F.transform("e", lambda x: x / F.col("m")))
    per = per.withColumn("m", F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, x: s + x * x)))
    return per.select("id", "label", F.size("e").alias("width"), "n", F.transform("e", lambda x: x / F.col("m")).alias("v"))


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node once for each order, with the key that sorts it."""
    for batch in batches:
        widths = batch["width"].to_numpy()
        for width in np.unique(widths):
            part = batch.filter(pa.array(widths == width))
            planes = np.random.default_rng(104729).normal(size=(SORTS, int(width), 62))
            x = matrix(part["v"])
            for sort in range(SORTS):
                key = ((x @ planes[sort]) > 0) @ (np.int64(1) << np.arange(61, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), sort, np.int32)), pa.array(key), *(part[c] for c in ("id", "label", "width", "v"))], ["sort", "key", "id", "label", "width", "v"])


def _successors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        group = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("sort", "label", "width")], axis=1)
        ids = batch["id"].to_numpy()
        edges = np.flatnonzero(np.any(np.diff(group, axis=0) != 0, axis=1)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(ids)]):
            x = matrix(batch["v"].slice(lo, hi - lo))
            for step in range(1, min(AHEAD, hi - lo - 1) + 1):
                a, b = ids[lo : hi - step], ids[lo + step : hi]
                yield pa.RecordBatch.from_arrays([*map(pa.array, (a, b, (x[:-step] * x[step:]).sum(1)))], ["a", "b", "s"])


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node among undirected edges."""
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "s").groupBy("a", "b").agg(F.max("s").alias("s"))
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("s"), "b"))
    return both.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def _join_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one node's neighbours that are nearer than the last of either's list."""
    for batch in batches:
        sizes = np.diff(batch["m"].offsets.to_numpy())
        for size in np.unique(sizes[sizes > 1]):
            rows = batch.filter(pa.array(sizes == size))
            flat = rows["m"].flatten()
            ids = flat.field("b").to_numpy().reshape(-1, size)
            last = flat.field("last").to_numpy().reshape(-1, size)
            v = matrix(flat.field("v")).reshape(len(ids), size, -1)
            near = np.einsum("gik,gjk->gij", v, v)
            worth = (near > np.minimum(last[:, :, None], last[:, None, :])) & (ids[:, :, None] < ids[:, None, :])
            g, i, j = np.nonzero(worth)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (ids[g, i], ids[g, j], near[g, i, j]))], ["a", "b", "s"])


def descend(spark: SparkSession, points: DataFrame, lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """Rounds of NN-descent from the given lists (a, b, s), until few entries change.

    Lists that hold links only are saturated: they are enlarged later, so their changes do not count.
    """
    for number in range(ROUNDS):
        last = lists.groupBy("a").agg(F.when(F.count("*") >= k, F.min("s")).otherwise(F.lit(-2.0)).alias("last"))
        around = lists.select("a", "b").union(lists.select("b", "a")).distinct().toDF("hub", "b")
        # A node in many lists meets its neighbours in parts of about 2 k, dealt anew each round.
        often = around.groupBy("hub").agg(F.ceil(F.count("*") / (2 * k)).alias("parts"))
        dealt = around.join(often, "hub").withColumn("part", F.pmod(F.xxhash64("hub", "b", F.lit(number)), "parts"))
        info = points.join(last, points["id"] == last["a"]).select(F.col("id").alias("b"), "last", "v")
        around = dealt.join(info, "b").groupBy("hub", "part").agg(F.collect_list(F.struct("b", "last", "v")).alias("m"))
        found = around.select("m").mapInArrow(_join_local, EDGE)
        new = stage(spark, _best(lists.unionByName(found), k), "lists")
        full = new.where(F.col("s") >= threshold).groupBy("a").count().where(F.col("count") >= k).select("a")
        changed = new.join(lists, ["a", "b"], "left_anti").join(full, "a", "left_anti").count()
        lists = new
        if changed <= SETTLED * new.count():
            break
    return lists


def _count_inside(threshold: float):
    def count(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"id": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "pairs": pd.Series(dtype="int64")})
        if not len(left) or not len(right):
            return out
        for width in np.intersect1d(left["width"], right["width"]):
            a, b = left[left["width"] == width], right[right["width"] == width]
            near = np.stack(a["v"].to_numpy()) @ np.stack(b["v"].to_numpy()).T
            same = (a["c"].to_numpy()[:, None] == b["c"].to_numpy()[None, :]) & (a["id"].to_numpy()[:, None] != b["id"].to_numpy()[None, :])
            ok = (near >= threshold) & same
            out = pd.concat([out, pd.DataFrame({"id": a["id"].to_numpy(), "links": ok @ b["n"].to_numpy(), "pairs": ok.sum(1)})])
        return out

    return count


def inner_links(points: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """id, links, pairs: how many other vectors, and nodes, of its component each node links with.

    Small components share a bin; a large one is cut into blocks, and each pair of blocks is a group.
    """
    inside = points.join(labels, "id").withColumnRenamed("component", "c").select("id", "n", "width", "v", "c")
    sizes = labels.groupBy("component").agg(F.count("*").alias("size")).withColumnRenamed("component", "c")
    bins = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(labels.count()) / BLOCK))
    placed = inside.join(sizes, "c").withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    placed = placed.withColumn("key", F.when(F.col("blocks") > 1, F.struct(F.lit(1).alias("own"), F.col("c").alias("at"))).otherwise(F.struct(F.lit(0).alias("own"), F.pmod(F.xxhash64("c"), bins).alias("at"))))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cols = ["id", "n", "width", "v", "c"]
    left = placed.select("key.own", "key.at", F.col("block").alias("i"), others.alias("j"), *cols)
    right = placed.select("key.own", "key.at", others.alias("i"), F.col("block").alias("j"), *cols)
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, for the cogroup
    at = ["own", "at", "i", "j"]
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_count_inside(threshold), "id long, links long, pairs long")
    return found.groupBy("id").agg(F.sum("links").alias("links"), F.sum("pairs").alias("pairs"))


def _links_of_blocks(threshold: float):
    def links(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a = b = np.zeros(0, np.int64)
        if len(left) and len(right):
            i, j = np.nonzero(np.stack(left["v"].to_numpy()) @ np.stack(right["v"].to_numpy()).T >= threshold)
            a, b = spanning(left["id"].to_numpy()[i], right["id"].to_numpy()[j])
        return pd.DataFrame({"a": a, "b": b})

    return links


def all_links(points: DataFrame, threshold: float) -> DataFrame:
    """a, b: links that connect what all links connect, from all pairs of blocks of each label."""
    sizes = points.groupBy("label", "width").agg(F.ceil(F.count("*") / ALL).alias("blocks"))
    placed = points.join(sizes, ["label", "width"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks"))
    left = placed.select("label", "width", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), "id", "v")
    right = placed.select("label", "width", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), "id", "v")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, for the cogroup
    at = ["label", "width", "i", "j"]
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_links_of_blocks(threshold), "a long, b long")


def _count_all(asked, threshold: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, widths, vectors = asked.value
        total = np.zeros(len(ids), np.int64)
        groups = {}  # label and width: which are asked, and their matrix
        for label, width in set(zip(labels.tolist(), widths.tolist())):
            mine = np.flatnonzero((labels == label) & (widths == width))
            groups[label, width] = mine, np.stack([vectors[i] for i in mine])
        for batch in batches:
            own_labels, own_widths = batch["label"].to_numpy(), batch["width"].to_numpy()
            for label, width in set(zip(own_labels.tolist(), own_widths.tolist())) & groups.keys():
                mine, x = groups[label, width]
                rows = np.flatnonzero((own_labels == label) & (own_widths == width))
                for lo in range(0, len(rows), ALL):
                    part = batch.take(pa.array(rows[lo : lo + ALL]))
                    ok = (x @ matrix(part["v"]).T >= threshold) & (ids[mine, None] != part["id"].to_numpy()[None, :])
                    total[mine] += ok.sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "pairs"])

    return count


def recall(spark: SparkSession, points: DataFrame, links: DataFrame, threshold: float = THRESHOLD) -> float:
    """Mean share of the true links that was found, over LINKED nodes with links (in the order of a hash) or all there are."""
    parts = max(1, -(-points.count() // AUDITED))
    linked, found = 0, 0.0
    for number in range(parts):
        some = points.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(parts)) == number).toPandas()
        if some.empty:
            continue
        sent = spark.sparkContext.broadcast((*(some[c].to_numpy() for c in ("id", "label", "width")), [np.asarray(v) for v in some["v"]]))
        true = points.mapInArrow(_count_all(sent, threshold), "id long, pairs long").groupBy("id").agg(F.sum("pairs").alias("there"))
        both = true.where("there > 0").join(links.select("id", "pairs"), "id", "left")
        share = F.least(F.coalesce("pairs", F.lit(0)) / F.col("there"), F.lit(1.0))
        more = both.agg(F.count("*"), F.coalesce(F.sum(share), F.lit(0.0))).first()
        linked, found = linked + more[0], found + more[1]
        if linked >= LINKED:
            break
    return found / linked if linked else 1.0


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, k: int = K) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    points = stage(spark, nodes(vectors), "nodes")
    keyed = points.mapInArrow(_signs, "sort int, key long, id long, label long, width int, v array<double>")
    ordered = keyed.repartitionByRange("sort", "label", "width", "key", "id").sortWithinPartitions("sort", "label", "width", "key", "id")
    lists = stage(spark, _best(ordered.mapInArrow(_successors, EDGE), k), "lists")
    for size in (k, 2 * k, 4 * k):
        lists = descend(spark, points, lists, size, threshold)
        labels = stage(spark, components(spark, lists.where(F.col("s") >= threshold).select("a", "b")), "labels")
        links = stage(spark, inner_links(points, labels, threshold), "inner-links")
        if recall(spark, points, links, threshold) >= RECALL:
            break
    else:
        labels = stage(spark, components(spark, all_links(points, threshold)), "labels")
        links = stage(spark, inner_links(points, labels, threshold), "inner-links")
    per = points.select("id", "n").join(labels, "id", "left").join(links.select("id", "links"), "id", "left")
    per = per.select("id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("c"))
    e = F.col("embedding").cast("array<double>").alias("e")
    known = usable(vectors.select("vec_id", "label", "embedding")).where("label is not null and vec_id is not null").select("vec_id", "label", e)
    heads = known.groupBy("label", "e").agg(F.min("vec_id").alias("id"))
    member = known.join(heads, ["label", "e"]).select(F.col("vec_id").alias("m"), "id").distinct().join(per, "id")
    # A vec_id that stands for several vectors has the links of all and the smallest component.
    member = member.groupBy("m").agg(F.sum("links").alias("links"), F.min("c").alias("c"))
    real = vectors.select("vec_id").join(member, F.col("vec_id") == F.col("m"), "left")
    own = F.coalesce("c", "vec_id")
    return real.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))
