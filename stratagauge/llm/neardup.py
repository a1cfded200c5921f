"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

1. One pass counts in how many documents each shingle occurs, in a table of DF_CELLS hashed cells.
   A shingle weighs its count in the text times 1 + log(N / df) / log(N), which is between 1 and 2.
2. A second pass draws improved consistent weighted samples of each text; BANDS keys of
   ROWS samples each become its buckets. Texts with the same words share one representative.
3. Members of a bucket are compared by exact weighted Jaccard similarity and linked from
   `threshold` on; linked documents form a class, named by its smallest doc_id.

With 16 bands of 5 samples, a pair at 0.8 meets in a bucket with probability 0.998, at 0.9 surely.

Defined results: texts of fewer than five words are one shingle; null texts and texts without words are linked
with nothing and are classes of their own; rows that repeat a doc_id are told apart by their text: those with the same words
are one document, others may have different classes; a row whose doc_id is null is in no class (null) and not kept; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import bitmap, flagged, fresh, link_buckets, may_hold, stage, table
from stratagauge.llm.tokens import P, mixed, shingles, shingles_of_texts, slices, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 5
#: Cells of the document frequencies; bounded, 2 MB.
DF_CELLS = 1 << 18
#: Draws of (rate, shift, level) that hashes pick from.
DRAWS = 1 << 16
#: Texts whose keys a task remembers.
REMEMBERED = 20_000
#: Shingles of a long text that are sampled at a time; shingles compared with their bounds at a time, and texts whose samples are settled together.
CHUNK, COLUMNS, TOGETHER = 4096, 512, 512
#: Weights up to e^(KINDS / PER) have bounds of their own kind. Bounds are rounded down to STEP from LEAST on.
KINDS, PER, LEAST, STEP = 16, 8, -16.0, 0.0625
#: A text's least draws are looked for up to here; about one in e^MEAN lies above and is looked for among all.
MEAN = 7.0


def _sorted_texts(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sorts the values of each text in place; where its different ones stand."""
    for lo, hi in zip(begin.tolist(), begin[1:].tolist()):
        values[lo:hi].sort()
    new = np.append(True, values[1:] != values[:-1])[: len(values)]
    new[begin[:-1][np.diff(begin) > 0]] = True
    return np.flatnonzero(new)


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, n = np.zeros(DF_CELLS, np.int64), 0
    for batch in batches:
        n += batch.num_rows
        for part in slices(batch, "text"):
            cell, begin = shingles_of_texts(*word_hashes(part["text"]), SHINGLE)
            cell = (cell % np.uint64(DF_CELLS)).astype(np.int64)
            cells += np.bincount(cell[_sorted_texts(cell, begin)], minlength=DF_CELLS)
    at = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(cells[at], n))], ["cell", "n"])


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """Weight of a shingle in each hashed cell, from all documents."""
    per = documents.select("text").mapInArrow(_frequency_batches, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = per["cell"].to_numpy(), per["n"].to_numpy()
    total = max(2, int(n[cell < 0].sum()))
    df = np.ones(DF_CELLS)
    df[cell[cell >= 0]] = n[cell >= 0]
    return (1 + np.log(total / df) / np.log(total)).astype(np.float32)


def weighted(hashes: np.ndarray, begin: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, their weights, and where each text begins among them."""
    found, begin = shingles_of_texts(hashes, begin, SHINGLE)
    at = _sorted_texts(found, begin)
    times = np.diff(np.append(at, len(found)))
    found = found[at]
    return found, times.astype(np.float32) * idf[(found % np.uint64(DF_CELLS)).astype(np.int64)], np.searchsorted(at, begin)


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """1/r, r, log c and beta of improved consistent weighted sampling; fixed by a seed."""
    rng = np.random.default_rng(20230501)
    r, c, beta = rng.gamma(2, 1, DRAWS), rng.gamma(2, 1, DRAWS), rng.uniform(0, 1, DRAWS)
    return tuple(x.astype(np.float32) for x in (1 / r, r, np.log(c), beta))


def _seeds(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * P) | np.uint64(1)


def samples(found: np.ndarray, weight: np.ndarray, draws: tuple, n: int | np.ndarray = BANDS * ROWS) -> np.ndarray:
    """n consistent samples (hashes of shingle and level), or those of the seeds n: two texts agree in each with a probability of their weighted Jaccard similarity."""
    inverse, r, c, beta = draws
    seeds = _seeds(n) if isinstance(n, int) else n
    n = len(seeds)
    best, out, rows = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64), np.arange(n)
    for lo in range(0, len(found), CHUNK):
        s, log_w = found[lo : lo + CHUNK], np.log(weight[lo : lo + CHUNK])
        at = ((s[None, :] * seeds[:, None]) >> np.uint64(48)).astype(np.int32)
        rate = r[at]
        level = np.floor(log_w[None, :] * inverse[at] + beta[at])
        a = c[at] - rate * (level - beta[at] + 1)
        i = a.argmin(1)
        least = a[rows, i]
        better = least < best
        best[better] = least[better]
        key = mixed(s[i] + seeds) + level[rows, i].astype(np.int64).astype(np.uint64) * P
        out[better] = key[better]
    return out


def _bound(values: np.ndarray) -> np.ndarray:
    return np.clip((values - LEAST) / STEP, 0, 255).astype(np.uint8)


def _bounds(draws: tuple) -> np.ndarray:
    """Below what no shingle of a kind comes, for each draw; the last kind is for all larger weights and leaves out the weight."""
    inverse, r, c, beta = draws
    tight = [c - r * (np.floor(np.float32(k / PER) * inverse + beta) - beta + 1) for k in range(KINDS)]
    return _bound(np.concatenate([*tight, c - r - np.float32(1e-3)]))


def samples_of_texts(found: np.ndarray, weight: np.ndarray, begin: np.ndarray, draws: tuple, bounds: np.ndarray) -> np.ndarray:
    """What `samples` gives for each text, one row for each; texts have shingles.

    A sample is the shingle with the least draw. The least of n draws lies near -log(sum of weights), so nearly all shingles
    are ruled out by the bound of their draw; the others, a few for each sample, are drawn in full.
    """
    inverse, r, c, beta = draws
    seeds, log_w, n = _seeds(BANDS * ROWS), np.log(weight), len(begin) - 1
    text = np.repeat(np.arange(n), np.diff(begin))
    most = np.log(MEAN / np.add.reduceat(weight, begin[:-1], dtype=np.float64)).astype(np.float32)
    kind = np.minimum(np.ceil(log_w * PER), KINDS).astype(np.int64)
    upto = _bound(most[text] + np.where(kind < KINDS, 0, log_w))
    kind *= DRAWS
    chosen = []
    for lo in range(0, len(found), COLUMNS):
        at = found[lo : lo + COLUMNS] * seeds[:, None]
        at >>= np.uint64(48)
        at = at.view(np.int64)
        at += kind[lo : lo + COLUMNS]
        row, i = np.divmod(np.flatnonzero(bounds.take(at) <= upto[lo : lo + COLUMNS]), at.shape[1])
        i += lo
        chosen.append((text[i] * len(seeds) + row) * len(found) + i)
    group, i = np.divmod(np.sort(np.concatenate(chosen)), len(found))
    seed = seeds[group % len(seeds)]
    at = ((found[i] * seed) >> np.uint64(48)).view(np.int64)
    level = np.floor(log_w[i] * inverse[at] + beta[at])
    a = c[at] - r[at] * (level - beta[at] + 1)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    least = np.minimum.reduceat(a, first) if len(first) else a
    equal = np.flatnonzero(a == np.repeat(least, np.diff(np.append(first, len(a)))))
    at = equal[np.searchsorted(equal, first)]
    sure = least <= most[group[at] // len(seeds)]
    at = at[sure]
    out, open_ = np.zeros((n, len(seeds)), np.uint64), np.ones((n, len(seeds)), np.bool_)
    out.ravel()[group[at]] = mixed(found[i[at]] + seed[at]) + level[at].astype(np.int64).astype(np.uint64) * P
    open_.ravel()[group[at]] = False
    for t in np.flatnonzero(open_.any(1)).tolist():
        own = slice(begin[t], begin[t + 1])
        out[t, open_[t]] = samples(found[own], weight[own], draws, seeds[open_[t]])
    return out


def band_keys(drawn: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each text."""
    rows = drawn.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(ROWS):
        key = mixed(key * P + rows[:, :, i])
    return key.view(np.int64)


def _signer(idf):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, draws, signed = idf.value, _draws(), {}
        bounds = _bounds(draws)
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, begin = word_hashes(part["text"])
                bodies = [xxhash.xxh3_128_digest(hashes[lo:hi]) if hi > lo else None for lo, hi in zip(begin.tolist(), begin[1:].tolist())]
                at = {body: i for i, body in enumerate(bodies) if body is not None}
                keys = {body: signed[body] for body in at if body in signed}
                new = [body for body in at if body not in keys]  # copies are signed once a task
                if len(signed) + len(new) > REMEMBERED:
                    signed.clear()
                for lo in range(0, len(new), TOGETHER):
                    some = [at[body] for body in new[lo : lo + TOGETHER]]
                    own = np.concatenate([hashes[begin[i] : begin[i + 1]] for i in some])
                    found, weight, ends = weighted(own, np.concatenate([[0], np.cumsum(np.diff(begin)[some])]), table_)
                    signed.update(zip(new[lo : lo + TOGETHER], band_keys(samples_of_texts(found, weight, ends, draws, bounds))))
                keys |= {body: signed[body] for body in new}
                bands = pa.array([keys.get(body) for body in bodies], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["th"], pa.array(bodies, pa.binary()), bands], ["doc_id", "th", "body", "bands"])

    return sign


def _taker(bits):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False)
            for part in slices(batch.filter(pa.array(may_hold(bits.value, ids))), "text"):
                hashes, begin = word_hashes(part["text"])
                bodies = [xxhash.xxh3_128_digest(hashes[lo:hi].tobytes()) for lo, hi in zip(begin, begin[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary()), part["text"]], ["body", "text"])

    return take


def _features(idf):
    """Shingles by occurrence: the k-th time a text holds a shingle is a feature that weighs its IDF."""

    def make():
        def of(texts: pa.Array) -> list:
            hashes, begin = word_hashes(texts)
            return [leveled(hashes[lo:hi], idf.value) for lo, hi in zip(begin, begin[1:])]

        return of

    return make


def leveled(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of one text; the smaller of two counts is then the number of features in common."""
    found = np.sort(shingles(hashes, SHINGLE))
    first = np.concatenate([[0], np.flatnonzero(np.diff(found)) + 1]) if len(found) else np.zeros(0, np.int64)
    level = np.arange(len(found)) - np.repeat(first, np.diff(np.append(first, len(found))))
    ids = np.where(level == 0, found, mixed(found + level.astype(np.uint64) * P))
    order = np.argsort(ids)
    return ids[order], idf[(found % np.uint64(DF_CELLS)).astype(np.int64)].astype(np.float64)[order]


def _classes(spark: SparkSession, documents: DataFrame, threshold: float) -> DataFrame:
    """doc_id, th (hash of the text) and first (doc_id and th of the class's first text) of every row.

    first is null for rows without words or without doc_id.
    """
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(texts))
    signed = stage(spark, texts.mapInArrow(_signer(idf), "doc_id long, th long, body binary, bands array<long>"), "signed")
    with_body = signed.where("body is not null and doc_id is not null")
    heads = with_body.groupBy("body").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.any_value("bands").alias("bands"))
    # Written once, so the ids stay what they are; a doc_id may stand for several texts.
    heads = stage(spark, heads.withColumn("id", F.monotonically_increasing_id()), "heads")
    spread = heads.select(F.explode("bands").alias("bucket"), "id").distinct()
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(spark, spread.join(shared.select("bucket"), "bucket"), "members")
    wanted = heads.join(members.select("id").distinct(), "id", "left_semi").select("id", "body", F.col("first.doc_id").alias("doc_id"))
    wanted = stage(spark, wanted, "wanted")
    bits = spark.sparkContext.broadcast(bitmap(wanted, "doc_id"))
    near = texts.select("doc_id", "text").mapInArrow(_taker(bits), "body binary, text string").join(wanted.select("id", "body"), "body")
    near = stage(spark, near.select("id", "text").dropDuplicates(["id"]), "near-texts")

    labels = link_buckets(spark, members, near, _features(idf), threshold)
    joined = heads.join(labels, "id").select("body", "first", "component")
    least = joined.groupBy("component").agg(F.min("first").alias("class_first"))
    joined = joined.join(least, "component").select(F.col("body").alias("key"), "class_first")
    alone = heads.join(labels.select("id"), "id", "left_anti").select(F.col("body").alias("key"), F.col("first").alias("class_first"))
    named = joined.unionByName(alone)
    out = signed.join(named, (F.col("body") == F.col("key")) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", "th", F.col("class_first").alias("first"))


def classes(spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id of every row."""
    found = _classes(spark, documents, threshold)
    return found.select("doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(spark, table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def unique_documents(spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one text of each class, that of the smallest doc_id, and one of rows that are equal in doc_id and text.

    Rows without doc_id or without words stay; so do different texts under one doc_id that are in classes of their own.
    """
    found = stage(spark, _classes(spark, documents, threshold), "classes").where("first is not null")
    stays = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.th") == F.col("th"))
    per = found.groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.min(stays).alias("stays")).where("n > 1 or not stays")
    doc, th, flag = (fresh(documents, name) for name in ("doc", "th", "stays"))
    per = stage(spark, per.select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("stays").alias(flag)), "repeated-documents")
    bits = spark.sparkContext.broadcast(bitmap(per, doc))
    hit = documents.mapInArrow(flagged(bits, True), documents.schema)
    hit = hit.join(per, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left")
    one = hit.where(F.col(flag)).dropDuplicates([doc, th]).unionByName(hit.where(F.col(flag).isNull()))
    return one.select(*documents.columns).unionByName(documents.mapInArrow(flagged(bits, False), documents.schema))
