"""Fuzzy line dedup: MinHash over character shingles, banding, exact check, union-find.

A line is compared in lower case without white space at its ends. Lines of the whole corpus whose character
shingles have a Jaccard similarity of `THRESHOLD` or more are linked; of each component the line
of the smallest (doc_id, hash of the text, line number) stays and all others are removed from their texts, also inside one document.

With 12 bands of 4 hashes a pair at 0.8 meets in a bucket with probability 0.998, at 0.85 surely.

Defined results: lines of fewer than MIN_CHARS characters are compared exactly; blank lines stay as they are; null and empty texts stay; a document whose lines are all removed gets an empty text
and `n_lines` 0; rows that repeat a doc_id are told apart by their text, and only rows equal in both share their decisions; a row
whose doc_id is null passes unchanged and its lines count for nobody; other columns of the input are kept; ties cannot
occur, as places are ordered; texts of any number of lines are cut in one pass over them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import bitmap, fresh, link_buckets, may_hold, stage, table
from stratagauge.llm.tokens import P, mixed, slices

SHINGLE, THRESHOLD, MIN_CHARS = 8, 0.8, 16
BANDS, ROWS = 12, 4
#: Text bytes whose lines are hashed at a time; a longer text is still taken whole.
SLICE = 1_000_000
#: Characters whose shingles are held in cache at a time.
CACHED = 1 << 17
#: Keys that a task packs at a time, and bytes of text for each cell that the packed keys are dealt to.
HELD, CELL = 1 << 19, 1 << 22

KEY = "hi long, lo long"


def _lines(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Normalized lines that are not blank, with their document row and line number."""
    lists = pc.split_pattern(pc.fill_null(part["text"], "").cast(pa.large_string()), "\n")
    flat, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    row = np.repeat(np.arange(part.num_rows), np.diff(at))
    number = np.arange(len(flat)) - at[:-1][row]
    flat = pc.utf8_trim_whitespace(pc.utf8_lower(flat))
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False) & part["doc_id"].is_valid().to_numpy(zero_copy_only=False)[row]
    return flat.filter(pa.array(keep)), row[keep], number[keep]


def _documents(part: pa.RecordBatch, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """doc_id and hash of the text of the documents that lines are in."""
    return tuple(part[name].fill_null(0).to_numpy(zero_copy_only=False)[row] for name in ("doc_id", "th"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", F.xxhash64("text").alias("th"))


def _keys(lines: list[str]) -> np.ndarray:
    """Two 64-bit halves of each line's hash."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in lines), ">i8").astype(np.int64).reshape(-1, 2)


def signatures(lines: list[str]) -> np.ndarray:
    """MinHash of the character shingles of each line: one row of uint32 for each."""
    factors = (mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * P) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(lines), len(factors)), np.uint32)
    ends = np.cumsum([len(x) for x in lines], dtype=np.int64)
    # In runs of whole lines that stay in the processor's cache.
    cuts = np.flatnonzero(np.diff(ends // CACHED)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lines)] if lines else []):
        hashes, counts = rolled(lines[lo:hi])
        own = (hashes >> np.uint64(32)).astype(np.uint32)
        starts, scaled = np.concatenate([[0], np.cumsum(counts)[:-1]]), np.empty_like(own)
        for k, factor in enumerate(factors):
            out[lo:hi, k] = np.minimum.reduceat(np.multiply(own, factor, out=scaled), starts)
    return out


def band_keys(drawn: np.ndarray) -> np.ndarray:
    rows = drawn.reshape(len(drawn), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(drawn), BANDS))
    for i in range(ROWS):
        key = mixed(key * P + rows[:, :, i])
    return key.view(np.int64)


def _dealt(keys: np.ndarray, ids: np.ndarray, exact: bool, cells: int) -> pa.RecordBatch:
    """Keys and their ids as one packed row for each cell that they fall into."""
    cell = ((keys.view(np.uint64) >> np.uint64(24)) % np.uint64(cells)).astype(np.min_scalar_type(cells))
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    at = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1]) if len(cell) else np.zeros(0, np.int64)
    offsets = pa.py_buffer((np.append(at, len(cell)) * 8).astype(np.int32))
    packed = [pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(x[order])]) for x in (keys, ids)]
    return pa.RecordBatch.from_arrays([pa.array(cell[at].astype(np.int64)), pa.array(np.full(len(at), exact)), *packed], ["cell", "exact", "keys", "ids"])


def _sign(cells: int):
    """Band keys and `hi` of the lines of MIN_CHARS characters and more, and `hi` and `lo` of all lines (exact).

    Each line comes once a slice, but twice in exact if it stands there more than once.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                flat, _, _ = _lines(part)
                if not len(flat):
                    continue
                coded = flat.dictionary_encode()
                lines, counts = coded.dictionary, np.bincount(coded.indices.to_numpy())
                keys = _keys(lines.to_pylist())
                long = pc.greater_equal(pc.utf8_length(lines), MIN_CHARS)
                bands = band_keys(signatures(lines.filter(long).to_pylist()))
                twice = np.repeat(keys, np.minimum(counts, 2), axis=0)
                held.append((bands.ravel(), np.repeat(keys[long.to_numpy(zero_copy_only=False), 0], BANDS), twice[:, 0], twice[:, 1]))
                n += bands.size + len(twice)
                if n >= HELD:
                    yield from flush(held)
                    held, n = [], 0
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        bands, owners, hi, lo = map(np.concatenate, zip(*held))
        yield _dealt(bands, owners, False, cells)
        yield _dealt(hi, lo, True, cells)

    return sign


def _shared(cell: tuple, group: pa.Table) -> pa.Table:
    """Of one cell: the ids under keys that hold several; if exact, the pairs of key and id that came more than once."""
    exact = cell[1].as_py()
    keys, ids = (np.frombuffer(b"".join(group[x].to_pylist()), np.int64) for x in ("keys", "ids"))
    order = np.argsort(keys)
    same = np.diff(keys[order]) == 0
    met = order[np.append(same, False) | np.append(False, same)]
    met = met[np.lexsort((ids[met], keys[met]))]
    keys, ids = keys[met], ids[met]
    again = np.append(False, (keys[1:] == keys[:-1]) & (ids[1:] == ids[:-1]))[: len(keys)]
    if exact:
        keep = ~again & np.append(again, False)[1:]
        keys, ids = keys[keep], ids[keep]
    else:
        keys, ids = keys[~again], ids[~again]
        same = keys[1:] == keys[:-1]
        keep = (np.append(same, False) | np.append(False, same))[: len(keys)]
        keys, ids = keys[keep], ids[keep]
    return pa.table({"exact": np.full(len(keys), exact), "key": keys, "id": ids})


def _places(met, repeated):
    """Places of lines that may be in a bucket with others or repeated; of the former also the text, once a slice."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                flat, row, number = _lines(part)
                if not len(flat):
                    continue
                coded = flat.dictionary_encode()
                codes, lines = coded.indices.to_numpy(), coded.dictionary
                keys = _keys(lines.to_pylist())
                short = pc.less(pc.utf8_length(lines), MIN_CHARS).to_numpy(zero_copy_only=False)
                told = may_hold(met.value, keys[:, 0]) & ~short
                at = np.flatnonzero((told | may_hold(repeated.value, keys[:, 0]))[codes])
                codes = codes[at]
                doc, th = _documents(part, row[at])
                first = np.zeros(len(codes), np.bool_)
                first[np.unique(codes, return_index=True)[1]] = True
                text = lines.cast(pa.string()).take(pa.array(codes, mask=~(first & told[codes])))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (keys[codes, 0], keys[codes, 1], doc, th, number[at], short[codes])), text], ["hi", "lo", "doc", "th", "line", "short", "text"]
                )

    return places


def rolled(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character shingles of the lines one after the other, and how many each line has."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    counts = np.maximum(lengths - SHINGLE + 1, 1)
    padded = np.concatenate([codes, np.zeros(SHINGLE, np.uint64)])
    out = padded[: len(codes)].copy()
    for i in range(1, SHINGLE):
        out = out * P + padded[i : i + len(codes)]
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    return mixed(out)[left >= np.repeat(lengths - counts + 1, lengths)], counts


def shingle_sets() -> Callable:
    """Sets of character shingles, all of weight 1."""

    def of(texts: pa.Array) -> list:
        lines, out = texts.to_pylist(), []
        for lo in range(0, len(lines), 500):  # in parts that stay in the cache
            hashes, counts = rolled(lines[lo : lo + 500])
            ends = np.cumsum(counts).tolist()
            for begin, end in zip([0, *ends], ends):
                own = np.sort(hashes[begin:end])
                own = own[np.append(True, own[1:] != own[:-1])]
                out.append((own, np.ones(len(own))))
        return out

    return of


def repeated_lines(spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc, th, line, short, keep_doc, keep_line: each line to remove, and the place of the line that stays for it.

    Lines are grouped by a 128-bit hash; those under MIN_CHARS characters have no band keys, so only their exact repeats are found.
    """
    texts = _texts(documents)
    size = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    signed = texts.mapInArrow(_sign(size // CELL + 1), "cell long, exact boolean, keys binary, ids binary")
    shared = stage(spark, signed.groupBy("cell", "exact").applyInArrow(_shared, "exact boolean, key long, id long"), "shared")
    members = shared.where("not exact").select(F.col("key").alias("bucket"), F.col("id").alias("hi"))
    repeated = shared.where("exact").select(F.col("key").alias("hi"), F.col("id").alias("lo"))
    wanted = stage(spark, members.select("hi").distinct(), "wanted")
    met, again = (spark.sparkContext.broadcast(bitmap(x, "hi")) for x in (wanted, repeated))
    places = stage(spark, texts.mapInArrow(_places(met, again), f"{KEY}, doc long, th long, line long, short boolean, text string"), "places")
    near = places.where("text is not null").join(wanted, "hi", "left_semi").groupBy("hi", "lo").agg(F.any_value("text").alias("text"))
    # Written once, so the ids stay what they are.
    near = stage(spark, near.withColumn("id", F.monotonically_increasing_id()), "line-texts")
    # Two lines of one `hi` are both members then: one more comparison, no other result.
    members = stage(spark, members.join(near.select("hi", "id"), "hi").select("bucket", "id"), "members")

    labels = link_buckets(spark, members, near.select("id", "text"), shingle_sets, threshold)
    linked = near.select("hi", "lo", "id").join(labels, "id").select("hi", "lo", F.lit(True).alias("linked"), F.col("component").alias("a"), F.lit(0).cast("long").alias("b"))
    alone = repeated.join(linked, ["hi", "lo"], "left_anti").select("hi", "lo", F.lit(False).alias("linked"), F.col("hi").alias("a"), F.col("lo").alias("b"))
    group = ["linked", "a", "b"]
    named = places.drop("text").join(linked.unionByName(alone), ["hi", "lo"]).select(*group, "doc", "th", "line", "short")
    named = stage(spark, named, "repeated")
    # Written apart from the join, so that adaptive execution can split the places of a very large group there.
    keep = stage(spark, named.groupBy(*group).agg(F.min(F.struct("doc", "th", "line")).alias("keep")), "keep")
    out = named.join(keep, group).where("not (doc = keep.doc and th = keep.th and line = keep.line)")
    return out.select("doc", "th", "line", "short", F.col("keep.doc").alias("keep_doc"), F.col("keep.line").alias("keep_line"))


def duplicate_lines(spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """What `repeated_lines` finds among lines of MIN_CHARS characters and more."""
    return repeated_lines(spark, documents, threshold).where("not short").drop("short")


def cut_lines(spark: SparkSession, documents: DataFrame, removed: str, left: str, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with repeated lines removed from `text`, and the numbers of lines removed and left under two new names."""
    drop = repeated_lines(spark, documents, threshold)
    doc, th, lines = (fresh(documents, name) for name in ("doc", "th", "lines"))
    per = drop.groupBy(F.col("doc").alias(doc), F.col("th").alias(th)).agg(F.collect_set(F.col("line").cast("int")).alias(lines))
    # One small row for each text: hashed in its partition, so that the texts need not be sorted.
    per = stage(spark, per, "removed-by-doc").hint("shuffle_hash")
    hit = documents.where("doc_id is not null").join(per, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left").drop(doc, th)
    # Bound to a name once, or every line would split the text anew; what stays is found with a hash set, in linear time.
    places = lambda all_: F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col(lines))
    cut = F.transform(F.array(F.split("text", "\n")), lambda all_: F.array_join(F.transform(places(all_), lambda i: F.get(all_, i)), "\n"))[0]
    n = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    gone = F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(cut)
    rest = documents.where("doc_id is null").withColumn(lines, F.lit(None).cast("array<int>"))
    return hit.unionByName(rest).select(
        *[text.alias(c) if c == "text" else F.col(c) for c in documents.columns],
        gone.cast("long").alias(removed),
        (n - gone).cast("long").alias(left),
    )


def dedup_lines(spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with repeated lines removed from `text`, and n_removed, n_lines (lines left) in place of such columns."""
    return cut_lines(spark, documents.drop("n_removed", "n_lines"), "n_removed", "n_lines", threshold)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(spark, documents)
