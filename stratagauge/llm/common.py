"""Staging, candidate filters, linking inside buckets and union-find, shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.tokens import slices
from stratagauge.session import scratch_dir

#: A candidate bitmap has 16 bits for each candidate, but no more than these (16 MB).
MOST_BITS = 1 << 27
#: Edges that a task makes stars of at a time.
PIECE = 1 << 18


def stage(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_by_hash(df: DataFrame, order: str, n: int, rows: int, *ties: str) -> DataFrame:
    """The n rows with the smallest scrambled `order` (long), or a few less; `rows` is how many df has.

    A cut on the hash leaves about 2 n rows before they are sorted in one task.
    """
    scrambled = F.pmod(F.xxhash64(order, F.lit(29)), F.lit(1 << 30))
    cut = (1 << 30) if rows <= 2 * n else (2 * n << 30) // rows
    return df.where(scrambled < cut).orderBy(scrambled, order, *ties).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of df has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap over pmod(id) of the ids, for dropping most of what cannot join before a shuffle.

    Its size follows the number of ids up to MOST_BITS, so it is bounded wherever it is sent; when it
    fills up at that bound it lets more rows pass, and the join after it stays exact.
    """
    n = ids.count()
    bits = 1 << 10
    while bits < min(16 * n, MOST_BITS):
        bits <<= 1
    at = F.pmod(F.col(column), F.lit(bits))
    words = (
        ids.select(F.floor(at / 64).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the int64 ids whose bit is set."""
    at = np.mod(ids, len(bits) * 64)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def flagged(bits, yes: bool):
    """For mapInArrow: the rows whose doc_id may be in a broadcast bitmap, or (yes=False) all others."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            hit = may_hold(bits.value, ids.fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == yes))

    return keep


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each id to the smallest one that the links a-b connect it with; none from that one."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.split(at, 2)
    top = np.arange(len(ids))
    while len(x):
        one, two = top[x], top[y]
        np.minimum.at(top, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(above := top[top], top):
            top = above
        apart = top[x] != top[y]
        x, y = x[apart], y[apart]
    below = np.flatnonzero(top != np.arange(len(ids)))
    return ids[below], ids[top[below]]


def _contract(piece: int):
    """For mapInArrow: the edges of a task as stars, about `piece` edges at a time."""

    def flush(held: list) -> pa.RecordBatch:
        both = (np.concatenate([batch[c].to_numpy() for batch in held]) for c in "ab")
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*both)], ["a", "b"])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= piece:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return contract


def components(spark: SparkSession, edges: DataFrame, piece: int = PIECE) -> DataFrame:
    """Connected components: pieces of the edges made stars, then alternating large-star and small-star steps.

    edges: a, b (long). Returns id, component (the smallest id reachable) for each id on an edge.
    Each step is a group-by with map-side combining and an equi-join that adaptive execution can split. A graph of one
    piece needs no step: each takes five shuffles, and the driver keeps the plans and the figures of all their tasks.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    now = stage(spark, now.mapInArrow(_contract(piece), "a long, b long"), "edges")
    pieces = max(1, -(-now.count() // piece))
    now = now.coalesce(pieces).mapInArrow(_contract(piece), "a long, b long")
    now = stage(spark, now.distinct() if pieces > 1 else now, "edges")
    mark = None
    while pieces > 1:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or state[0] == 0:
            break
        mark = tuple(state)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(spark, small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    below = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return below.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


#: Open buckets of up to so many members are compared as pairs, larger ones in blocks of BLOCK members.
SMALL, BLOCK, COLUMNS = 8, 256, 4096

#: Sorted feature hashes of a text and their weights.
Features = tuple[np.ndarray, np.ndarray]


def jaccard(a: Features, b: Features) -> float:
    """Weighted Jaccard similarity; a feature has one weight wherever it occurs."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = float(a[1][b[0][at] == a[0]].sum())
    return both / max(float(a[1].sum() + b[1].sum()) - both, 1e-30)


def jaccard_block(left: list[Features], right: list[Features]) -> np.ndarray:
    """The similarities of all of left with all of right, COLUMNS features at a time."""
    seen = [np.unique(np.concatenate([f[0] for f in side])) for side in (left, right)]
    shared = np.intersect1d(*seen, assume_unique=True)
    both = np.zeros((len(left), len(right)))
    for lo in range(0, len(shared), COLUMNS):
        part = shared[lo : lo + COLUMNS]
        sides = []
        for side, weigh in ((left, True), (right, False)):
            m = np.zeros((len(side), len(part)))
            for row, (ids, weights) in zip(m, side):
                own = slice(np.searchsorted(ids, part[0]), np.searchsorted(ids, part[-1], "right"))
                at = np.searchsorted(part, ids[own])
                hit = part[np.minimum(at, len(part) - 1)] == ids[own]
                row[at[hit]] = weights[own][hit] if weigh else 1
            sides.append(m)
        both += sides[0] @ sides[1].T
    sums = [np.array([f[1].sum() for f in side]) for side in (left, right)]
    return both / np.maximum(sums[0][:, None] + sums[1][None, :] - both, 1e-30)


def _judge_pairs(features, threshold: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features()
        for batch in batches:
            for part in slices(batch, "tb"):
                # Copies of one leader's text are described once.
                both = pa.concat_arrays([part["ta"], part["tb"]]).dictionary_encode()
                known = of(both.dictionary)
                sums = np.array([f[1].sum() for f in known])
                one, two = np.split(both.indices.to_numpy(), 2)
                # The similarity is at most the ratio of the sums.
                close = np.minimum(sums[one], sums[two]) >= threshold * np.maximum(sums[one], sums[two]) * (1 - 1e-9)
                keep = [c and jaccard(known[a], known[b]) >= threshold for a, b, c in zip(one, two, close)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return judge


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same ids as all links a-b of one block, without the redundant ones."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    keep = np.zeros(len(a), np.bool_)
    for n, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
            keep[n] = True
    return a[keep], b[keep]


def _judge_blocks(features, threshold: float):
    def judge(key, left: pa.Table, right: pa.Table) -> pa.Table:
        of = features()
        a, b = (side["id"].to_numpy() for side in (left, right))
        c, d = (side["c"].to_numpy() for side in (left, right))
        if len(a) and len(b):
            texts = [of(side["text"].combine_chunks()) for side in (left, right)]
            i, j = np.nonzero((jaccard_block(*texts) >= threshold) & (c[:, None] != d[None, :]))
            a, b = spanning(a[i], b[j])
        else:
            a = b = np.zeros(0, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return judge


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, id, c (component so far), n (members of the bucket); only buckets that lie in several components."""
    named = members.join(labels.withColumnRenamed("component", "k"), "id", "left")
    named = named.select("bucket", "id", F.coalesce("k", "id").alias("c"))
    open_ = named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    return named.join(open_.select("bucket", "n"), "bucket")


def link_buckets(spark: SparkSession, members: DataFrame, texts: DataFrame, features: Callable[[], Callable], threshold: float) -> DataFrame:
    """Components of the links (Jaccard similarity >= threshold) between members of one bucket.

    members: bucket, id (long), distinct. texts: id, text. features() gives, inside a task, a function
    from an Arrow array of texts to their Features.

    First all members of a bucket are compared with its smallest, so copies of one thing cost
    one comparison each. Buckets that still lie in several components are compared completely across
    components: small ones as pairs of rows, large ones in blocks that return links only. No link between members
    of a bucket that would join two components is lost. Returns id, component like `components`.
    """

    def verify(pairs: DataFrame) -> DataFrame:
        met = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        met = met.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        return met.select("a", "b", "ta", "tb").mapInArrow(_judge_pairs(features, threshold), "a long, b long")

    heads = members.groupBy("bucket").agg(F.min("id").alias("a"))
    pairs = members.join(heads, "bucket").where("a < id").select("a", F.col("id").alias("b")).distinct()
    pairs = stage(spark, pairs, "pairs")
    links = stage(spark, verify(pairs), "links")
    labels = stage(spark, components(spark, links), "labels")

    open_ = stage(spark, _open_members(members, labels), "open")
    # At most SMALL members in a row.
    small = open_.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.collect_list(F.struct("id", "c")).alias("all"))
    met = small.select("all", F.explode("all").alias("one")).select("one", F.explode("all").alias("two"))
    met = met.where("one.c <> two.c and one.id < two.id").select(F.col("one.id").alias("a"), F.col("two.id").alias("b")).distinct()
    found = stage(spark, verify(met.join(pairs, ["a", "b"], "left_anti")), "links")

    large = stage(spark, open_.where(F.col("n") > SMALL).join(texts, "id"), "large-buckets")
    # The largest component of a bucket needs no comparison with itself: left holds the others.
    per = large.groupBy("bucket", "c").agg(F.count("*").alias("m"))
    main = per.groupBy("bucket").agg(F.max(F.struct("m", "c")).alias("main"), F.sum("m").alias("all"))
    main = main.select("bucket", F.col("main.c").alias("main"), F.ceil((F.col("all") - F.col("main.m")) / BLOCK).alias("ls"), F.ceil(F.col("all") / BLOCK).alias("rs"))
    dealt = large.join(main, "bucket")
    at = lambda parts: F.pmod(F.xxhash64("id", F.lit(5)), F.col(parts))
    upto = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    left = dealt.where("c <> main").select("bucket", at("ls").alias("i"), upto("rs").alias("j"), "id", "c", "text")
    right = dealt.select("bucket", upto("ls").alias("i"), at("rs").alias("j"), "id", "c", "text")
    right = right.select(*[F.col(x).alias(x) for x in right.columns])  # columns of its own, for the cogroup
    blocks = left.groupBy("bucket", "i", "j").cogroup(right.groupBy("bucket", "i", "j"))
    dense = stage(spark, blocks.applyInArrow(_judge_blocks(features, threshold), "a long, b long").distinct(), "links")
    merged = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(found).unionByName(dense)
    return stage(spark, components(spark, merged), "labels")


def words_of(text: Column) -> Column:
    """How many runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
