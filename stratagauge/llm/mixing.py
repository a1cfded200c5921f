"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

Each source is a stream: its documents in a fixed shuffled order (by md5 of the id), repeated as often as
needed, cut into blocks of `block` words. Slots 0, 1, 2, ... of the mix get golden-ratio points;
a point falls into one source's interval of the cumulative target shares, so each stretch of the
schedule is mixed in proportion. The k-th slot of a source takes the k-th block of its stream.

Defined results: a null source is a source of its own and the last; null or empty texts have size 0
and are taken 0 times; rows that repeat a doc_id count each; a null doc_id sorts first; extra columns of the
input are ignored; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratagauge.llm.common import stage, table, words_of

#: Words in a block.
BLOCK = 1024
#: Weights of the sources in order, repeated.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a multiple of all words, as a fraction.
SHARE = (3, 2)
#: Most passes over one source.
PASSES = 2
#: The golden ratio's fraction times 2**31, rounded to an odd number; slots in a chunk.
GOLDEN, TURN, CHUNK = 1327217885, 1 << 31, 4096
#: About so many documents share a hash prefix when streams are laid out.
PREFIX_ROWS = 2048


def sized_documents(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and the shuffled order `h` of each row."""
    return documents.select(
        "doc_id", "source", words_of(F.col("text")).alias("size"), F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("h")
    )


def targets(sized: DataFrame) -> DataFrame:
    """Per source: s (rank from 1), source, source_size, target.

    Filling by weight up to PASSES times the source's size: in the order of size/weight, a source is
    full if its even share of what is left is above its bound; the first that is not sets the level
    for the rest. One row per source; the windows run over sources only.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("s", F.row_number().over(by_source))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("s") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    fill = W.orderBy(F.col("source_size") / F.col("w"), "s")
    before, after = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    cap = PASSES * F.col("source_size")
    wanted = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).partitionBy()) * SHARE[0] / SHARE[1]
    per = per.withColumns({"left": wanted - F.coalesce(F.sum(cap).over(before), F.lit(0)), "wsum": F.sum("w").over(after)})
    # Compared without a division: cap / w < left / wsum.
    per = per.withColumn("full", (cap * F.col("wsum")).cast("double") < F.col("w") * F.col("left"))
    first_open = F.first(F.when(~F.col("full"), F.struct("left", "wsum")), ignorenulls=True).over(
        fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    per = per.withColumn("open", first_open)
    return per.select("s", "source", "source_size", F.when(F.col("full"), cap.cast("double")).otherwise(F.col("w") * F.col("open.left") / F.col("open.wsum")).alias("target"))


def streams(sized: DataFrame, shares: DataFrame, rows: int) -> DataFrame:
    """s, doc_id, size, h, begin: where each non-empty document begins in its source's stream.

    A prefix sum in two levels: sums by (source, hash prefix), then inside a prefix. The prefix
    length follows the number of rows, so that no task holds a whole source.
    """
    digits = 0
    while 16**digits * PREFIX_ROWS < rows:
        digits += 1
    known = sized.where("size > 0").withColumn("p", F.substring("h", 1, digits))
    per = known.groupBy("source", "p").agg(F.sum("size").alias("part"))
    per = per.join(shares.select("s", F.col("source").alias("src")), F.col("source").eqNullSafe(F.col("src")))
    head = W.partitionBy("s").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    per = per.select("s", F.col("source").alias("src"), F.col("p").alias("pp"), F.coalesce(F.sum("part").over(head), F.lit(0)).alias("start"))
    laid = known.join(per, F.col("source").eqNullSafe(F.col("src")) & (F.col("p") == F.col("pp")))
    inside = W.partitionBy("s", "p").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return laid.select("s", "doc_id", "size", "h", (F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("begin"))


def schedule(spark: SparkSession, shares: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, s, k: slots in the order of the mix; a source's k counts from 0 to its last needed block.

    Slots that find their source filled stay unused; a source that the points leave short
    by a few blocks gets these after the last slot.
    """
    ends = W.orderBy("s").rowsBetween(W.unboundedPreceding, 0)
    need = shares.select("s", F.ceil(F.floor("target") / block).alias("need"), F.floor("target").alias("words"))
    need = need.withColumns({"upto": F.sum("words").over(ends), "all": F.sum("words").over(W.partitionBy())})
    need = need.withColumn("hi", F.floor(F.col("upto") * TURN / F.col("all")))
    need = need.withColumn("lo", F.lag("hi", 1, 0).over(W.orderBy("s")))
    need = need.where("need > 0").select("s", "need", "lo", "hi")
    total = need.agg(F.sum("need")).first()[0] or 0
    # A point's bucket among `cells` equal parts of the circle makes the interval lookup an equi-join.
    cells = 4096
    width = TURN // cells
    spans = need.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.least(F.floor(F.col("hi") / width), F.lit(cells - 1)))))
    slots = spark.range(total).select(F.col("id").alias("slot"), F.pmod(F.pmod("id", F.lit(TURN)) * GOLDEN, F.lit(TURN)).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / width))
    hit = slots.join(spans, "cell").where("point >= lo and point < hi").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    per = hit.groupBy("s", "chunk").count()
    earlier = W.partitionBy("s").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    per = per.select("s", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(W.partitionBy("s", "chunk").orderBy("slot")) - 1
    drawn = hit.join(per, ["s", "chunk"]).select("s", "need", "slot", (F.col("base") + rank).alias("k"))
    got = hit.groupBy("s").agg(F.count("*").alias("n"))
    short = need.join(got, "s", "left").select("s", "need", F.coalesce("n", F.lit(0)).alias("n")).where("n < need")
    tail = short.select("s", F.explode(F.sequence("n", F.col("need") - 1)).alias("k"))
    tail = tail.select((F.lit(total) + F.col("k")).alias("slot"), "s", "k")
    return drawn.where("k < need").select("slot", "s", "k").unionByName(tail)


def mix(spark: SparkSession, documents: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized documents, targets per source, pieces of the mix).

    pieces: slot, s, k, doc_id, first_word, n_words: the words of a document that a slot takes, in the
    document's own word numbers; a document that ends in one block goes on in the next.
    """
    sized = stage(spark, sized_documents(documents), "sized")
    shares = stage(spark, targets(sized), "targets")
    laid = streams(sized, shares, sized.count())
    plan = schedule(spark, shares, block)
    bounds = shares.select("s", "source_size", F.floor("target").alias("words"))
    # A document meets the blocks of each pass over its stream.
    turns = laid.join(bounds, "s").select("*", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))).alias("turn"))
    turns = turns.withColumn("at", F.col("turn") * F.col("source_size") + F.col("begin"))
    turns = turns.where("at < words").withColumn("until", F.least(F.col("at") + F.col("size"), F.col("words")))
    spread = turns.withColumn("k", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("until") - 1) / block))))
    met = spread.join(plan, ["s", "k"])
    start = F.greatest("at", F.col("k") * block)
    pieces = met.select(
        "slot", "s", "k", "doc_id", "h", "size", (start - F.col("at")).alias("first_word"),
        (F.least(F.col("until"), (F.col("k") + 1) * block) - start).alias("n_words"),
    )
    return sized, shares, pieces


def taken_words(spark: SparkSession, documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row; rows with one id and size share evenly."""
    sized, shares, pieces = mix(spark, documents, block)
    per = pieces.groupBy("s", F.col("doc_id").alias("d"), F.col("size").alias("z")).agg(F.sum("n_words").alias("got"))
    copies = sized.groupBy("source", "doc_id", "size", "h").agg(F.count("*").alias("n"))
    named = shares.withColumnRenamed("source", "src")
    copies = copies.join(named, F.col("source").eqNullSafe(F.col("src")))
    same = (copies["s"] == per["s"]) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
    out = copies.join(per, same, "left").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = F.coalesce("got", F.lit(0))
    share = F.floor(got / F.col("n")) + F.when(F.col("i") <= F.pmod(got, F.col("n")), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", share.cast("long").alias("taken"))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(spark, table(spark, sf_dir, "documents")).drop("source")


#: The blocks of a source cover its stream from the start to its target, so what a document gives
#: follows from its place in the stream.
OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS h,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS z, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(s - 1) % 3 + 1] AS w FROM per),
filled AS (
  SELECT *, (SELECT sum(z) FROM per) * 1.5 - coalesce(sum(2 * z) OVER (ORDER BY z / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) OVER (ORDER BY z / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wsum FROM weighed),
level AS (
  SELECT arg_min(lft, z / w) AS lft, arg_min(wsum, z / w) AS wsum FROM filled WHERE NOT (2 * z * wsum < w * lft)),
shares AS (
  SELECT source, z, CASE WHEN 2 * f.z * f.wsum < f.w * f.lft THEN CAST(2 * z AS DOUBLE)
    ELSE CAST(f.w * level.lft AS DOUBLE) / CAST(level.wsum AS DOUBLE) END AS target
  FROM filled f LEFT JOIN level ON true),
laid AS (
  SELECT d.doc_id, d.size, t.z, t.target, floor(t.target)::BIGINT AS words,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM sized d JOIN shares t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z AS source_size, target,
  CAST(greatest(least(b + size, words) - b, 0) + greatest(least(z + b + size, words) - (z + b), 0) AS BIGINT) AS taken
FROM laid
"""


def mixed_documents(spark: SparkSession, documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents of the mix, whole: each row as often as the mix takes it, to the nearest whole number."""
    taken = taken_words(spark, documents, block).where("taken > 0").groupBy("doc_id", "source", "size")
    times = F.round(F.avg(F.col("taken") / F.col("size"))).cast("int")
    per = taken.agg(times.alias("times")).where("times > 0").toDF("__doc", "__source", "__size", "__times")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size"))
    out = documents.withColumn("__words", words_of(F.col("text"))).join(per, same)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*documents.columns)
