"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into units that no piece crosses: runs of spaces with the word after them, and line feeds.
For the DICTIONARY most frequent units of the corpus, substrings of bounded length are exploded, joined
with the piece table, grouped by unit to a lattice, and folded by a higher-order aggregate: the best path
for unigram models (Viterbi), and for BPE models the merges in the order of their scores, since the best path
over BPE scores is not what such a model encodes. The result is broadcast (its size is bounded by DICTIONARY)
and looked up for all texts in place, so that texts are never shuffled; the remaining rare units get the same
rule in place, the merges of BPE models for all units of a slice together.

Defined results: null and empty texts have no pieces; characters without a piece become byte pieces (or the unknown
piece, if the model has none); U+2581 in a text is read as a space, as the model does; very long
texts and units are taken whole; the ids depend on the text alone, so rows that repeat agree; extra columns
stay; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import stage, table
from stratagauge.llm.tokens import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Most units that get a lattice and are broadcast; longest unit among them, in characters.
DICTIONARY, LONGEST = 1 << 18, 48
#: Text bytes that are encoded at a time; a longer text is still taken whole.
SLICE = 3_000_000
SPACE = "▁"
# Kinds of pieces and of models in the model file.
NORMAL, USER, BYTE, UNIGRAM = 1, 4, 6, 1


@dataclass
class Pieces:
    """A model: piece -> (id, score), ids of byte pieces (255 is the largest byte), what each id decodes to."""

    scores: dict[str, tuple[int, float]]
    bytes_: list[int]
    unknown: int
    decoded: list[bytes]
    unigram: bool
    prefix: bool

    @property
    def longest(self) -> int:
        return max(map(len, self.scores), default=1)


def load(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model file on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    scores, bytes_, decoded, unknown = {}, [-1] * 256, [], model.trainer_spec.unk_id
    for i, p in enumerate(model.pieces):
        if p.type == BYTE:
            bytes_[int(p.piece[3:5], 16)] = i
            decoded.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type in (NORMAL, USER):
            scores[p.piece] = (i, p.score)
            decoded.append(p.piece.replace(SPACE, " ").encode())
        else:
            decoded.append(" ⁇ ".encode() if i == unknown else b"")
    return Pieces(scores, bytes_ if min(bytes_) >= 0 else [], unknown, decoded, model.trainer_spec.model_type == UNIGRAM, model.normalizer_spec.add_dummy_prefix)


def units(texts: pa.Array, prefix: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct units of the texts, the number of each unit in sequence, and where each text begins in it.

    Units lie in the texts one after the other, each from a line feed, from what follows one, or from the first of some spaces.
    """
    large = lambda x: pa.scalar(x, pa.large_string())
    texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), SPACE, " ")
    if prefix:
        texts = pc.if_else(pc.equal(texts, large("")), large(""), pc.binary_join_element_wise(large(" "), texts, large("")))
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    line, space = raw == ord("\n"), raw == ord(" ")
    begins = line | space
    begins[1:] &= ~(space[1:] & space[:-1])
    begins[1:] |= line[:-1]
    begins[at[:-1][at[:-1] < at[1:]]] = True
    begins = np.flatnonzero(begins)
    flat = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(raw))), pa.py_buffer(raw))
    coded = flat.dictionary_encode()
    return pc.replace_substring(coded.dictionary, " ", SPACE), coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(begins, at)


def _count_units(prefix: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                known, codes, _ = units(part["text"], prefix)
                times = np.bincount(codes, minlength=len(known))
                seen.append(pa.table({"unit": known.cast(pa.string()), "n": times}).filter(pa.array(times > 0)))
                if len(seen) > 5:
                    seen = [pa.concat_tables(seen).group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"])]
        for out in pa.concat_tables(seen).group_by("unit").aggregate([("n", "sum")]).to_batches(100_000) if seen else ():
            yield pa.RecordBatch.from_arrays(out.columns, ["unit", "n"])

    return count


def _bytes_of(model: Pieces, char: Column) -> Column:
    """Ids for a character without a piece."""
    if not model.bytes_:
        return F.array(F.lit(model.unknown))
    ids = F.array(*map(F.lit, model.bytes_))
    code = F.hex(F.encode(char, "utf-8"))
    at = F.sequence(F.lit(1), F.length(code), F.lit(2))
    return F.transform(at, lambda i: F.element_at(ids, (F.conv(F.substr(code, i, F.lit(2)), 16, 10) + 1).cast("int")))


def _merged(edges: Column, n: Column) -> Column:
    """Bounds of the pieces of a unit: neighbours merge in the order of the score of their union, leftmost first.

    edges: map from start * 64 + length to (score, id); positions count from 1.
    """

    def step(bounds: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(bounds) - 2), lambda k: F.struct(
            edges[F.element_at(bounds, k) * 64 + F.element_at(bounds, k + 2) - F.element_at(bounds, k)]["score"].alias("score"), (-k).alias("k")))
        best = F.array_max(F.filter(pairs, lambda p: p["score"].isNotNull()))
        return F.when(F.size(bounds) < 3, bounds).otherwise(F.when(best.isNull(), bounds).otherwise(F.filter(bounds, lambda _, i: i != -best["k"])))

    return F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(1), n + 1), step)


def _best_path(edges: Column, n: Column) -> Column:
    """Bounds of the path with the largest sum of scores (Viterbi); of equal ones, that with the longer last piece.

    A character without a piece may stand alone at a score below all pieces.
    """
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array(F.lit(1)).alias("bounds")))

    def step(done: Column, end: Column) -> Column:
        def reach(begin: Column) -> Column:
            edge = edges[begin * 64 + end - begin + 1]["score"].cast("double")
            edge = F.when(edge.isNull() & (begin == end), F.lit(-1e6)).otherwise(edge)
            before = F.element_at(done, begin)
            return F.struct((before["score"] + edge).alias("score"), (-begin).alias("b"))

        best = F.array_max(F.filter(F.transform(F.sequence(F.greatest(F.lit(1), end - LONGEST), end), reach), lambda x: x["score"].isNotNull()))
        path = F.concat(F.element_at(done, -best["b"])["bounds"], F.array(end + 1))
        return F.concat(done, F.array(F.struct(best["score"].alias("score"), path.alias("bounds"))))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1)["bounds"]


def encode_units(spark: SparkSession, words: DataFrame, model: Pieces) -> DataFrame:
    """unit, ids of distinct units of LONGEST characters at most, by the lattice."""
    vocabulary = [(p, i, float(s)) for p, (i, s) in model.scores.items()]
    pieces = spark.createDataFrame(vocabulary, "piece string, id int, score double")  # bounded by the model
    starts = words.select("unit", F.explode(F.sequence(F.lit(1), F.length("unit"))).alias("i"))
    spans = starts.select("unit", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), F.length("unit") - F.col("i") + 1))).alias("l"))
    edges = spans.withColumn("piece", F.substr("unit", "i", "l")).join(F.broadcast(pieces), "piece", "left").where("id is not null or l = 1")
    entry = F.struct((F.col("i") * 64 + F.col("l")).alias("key"), F.struct("score", "id").alias("value"))
    lattice = edges.groupBy("unit").agg(F.map_from_entries(F.collect_list(entry)).alias("edges"))
    bounds = (_best_path if model.unigram else _merged)(F.col("edges"), F.length("unit"))
    lattice = lattice.withColumn("bounds", bounds)

    def ids(k: Column) -> Column:
        begin, end = F.element_at("bounds", k), F.element_at("bounds", k + 1)
        known = F.col("edges")[begin * 64 + end - begin]["id"]
        return F.when(known.isNotNull(), F.array(known)).otherwise(_bytes_of(model, F.substr("unit", begin, F.lit(1))))

    parts = F.transform(F.sequence(F.lit(1), F.size("bounds") - 1), ids)
    return lattice.select("unit", F.flatten(parts).alias("ids"))


def encode_rare(unit: str, model: Pieces) -> list[int]:
    """The same rule for one unit, with a heap or a best path."""
    n, scores = len(unit), model.scores
    if model.unigram:
        longest, best = model.longest, [(0.0, 0)]
        for end in range(1, n + 1):
            options = [(best[b][0] + scores[unit[b:end]][1], -b) for b in range(max(0, end - longest), end) if unit[b:end] in scores]
            if unit[end - 1] not in scores:
                options.append((best[end - 1][0] - 1e6, 1 - end))
            best.append(max(options))
        bounds = [n]
        while bounds[-1]:
            bounds.append(-best[bounds[-1]][1])
        spans = list(zip(bounds[::-1], bounds[-2::-1]))
    else:
        after, before, end = list(range(1, n + 1)), list(range(-1, n)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (known := scores.get(unit[i : end[j]])):
                heapq.heappush(heap, (-known[1], i, j, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if end[i] != j or after[i] != j or end[j] != stop:
                continue  # one side has changed since
            end[i], after[i] = stop, after[j]
            end[j] = -1
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        spans, i = [], 0
        while i < n:
            spans.append((i, end[i]))
            i = after[i]
    out: list[int] = []
    for lo, hi in spans:
        known = scores.get(unit[lo:hi])
        if known:
            out.append(known[0])
        else:
            out += [model.bytes_[b] for b in unit[lo:hi].encode()] if model.bytes_ else [model.unknown]
    return out


@dataclass
class Merges:
    """The merges of a BPE model in numbers: its symbols are all pieces and all characters in them."""

    symbol: np.ndarray  # of each code point; the last symbol is that of all other characters
    ids: np.ndarray  # id of each symbol's piece, -1 for none
    pairs: np.ndarray  # sorted: left symbol * number of symbols + right symbol
    union: np.ndarray  # symbol of a pair's union
    rank: np.ndarray  # the smallest merges first; the last is that of no pair


def merges(model: Pieces) -> Merges:
    names = [*model.scores, *sorted({c for p in model.scores for c in p} - set(model.scores))]
    number = {name: i for i, name in enumerate(names)}
    n = len(names) + 1
    symbol = np.full(0x110000, n - 1, np.int32)
    for name, i in number.items():
        if len(name) == 1:
            symbol[ord(name)] = i
    rank = {score: i for i, score in enumerate(sorted({score for _, score in model.scores.values()}, reverse=True))}
    found = sorted((number[p[:i]] * n + number[p[i:]], number[p], rank[score]) for p, (_, score) in model.scores.items() for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
    pairs, union, order = np.array(found, np.int64).reshape(-1, 3).T.copy()
    ids = [model.scores[name][0] if name in model.scores else -1 for name in names]
    return Merges(symbol, np.array([*ids, -1], np.int32), pairs, union, np.append(order, len(rank)))


def _pairs(m: Merges, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pair two symbols are; the number of pairs, if none."""
    key = left * len(m.ids) + right
    at = np.searchsorted(m.pairs, key)
    hit = np.append(m.pairs, -1)[at] == key
    return np.where(hit, at, len(m.pairs))


def merged(lines: pa.Array, m: Merges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of units that have characters, merged as `encode_rare` does: of some units the symbols, one unit after the other; the units; how many symbols each has.

    In each round every unit merges its best pair, the leftmost of equal ones; units without a pair are done.
    """
    points = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le"), np.uint32)
    size = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    sym, unit, none = m.symbol[points].astype(np.int64), np.arange(len(size)), len(m.pairs)
    last = np.cumsum(size) - 1
    pair = np.append(_pairs(m, sym[:-1], sym[1:]), none)
    pair[last] = none
    done = []
    while len(unit):
        begin, n = np.cumsum(size) - size, len(sym)
        best = np.minimum.reduceat(m.rank[pair] * n + np.arange(n), begin)
        more = best < m.rank[-1] * n
        if not more.all():
            stays = np.repeat(more, size)
            done.append((sym[~stays], unit[~more], size[~more]))
            shift = (np.cumsum(~stays) - ~stays)[best[more] % n]
            at = best[more] % n - shift
            sym, pair, unit, size = sym[stays], pair[stays], unit[more], size[more]
            begin = np.cumsum(size) - size
        else:
            at = best % n
        # The right half goes, so what follows an earlier unit's merge moves up by one.
        sym[at] = m.union[pair[at]]
        keep = np.ones(len(sym), np.bool_)
        keep[at + 1] = False
        first, end = at == begin, at + 2 == begin + size
        sym, pair, size = sym[keep], pair[keep], size - 1
        at = at - np.arange(len(at))
        pair[at[end]] = none
        pair[at[~end]] = _pairs(m, sym[at[~end]], sym[at[~end] + 1])
        pair[at[~first] - 1] = _pairs(m, sym[at[~first] - 1], sym[at[~first]])
    return tuple(np.concatenate(x) if done else np.zeros(0, np.int64) for x in (zip(*done) if done else ((), (), ())))


def encode_many(names: pa.Array, model: Pieces, m: Merges | None) -> pa.ListArray:
    """What `encode_rare` gives for each unit."""
    short = pc.less_equal(pc.utf8_length(names), LONGEST if m else 0).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(short)
    symbols, unit, size = merged(names.take(pa.array(some)), m) if len(some) else np.zeros((3, 0), np.int64)
    ids = m.ids[symbols] if len(some) else np.zeros(0, np.int32)
    at = np.concatenate([[0], np.cumsum(size)])
    # Units with a character that has no piece, and long ones, are left to the heap.
    whole = np.add.reduceat(ids < 0, at[:-1]) == 0 if len(size) else np.zeros(0, np.bool_)
    rest = np.sort(np.concatenate([some[unit[~whole]], np.flatnonzero(~short)])).astype(np.int64)
    own = pa.array([encode_rare(u, model) for u in names.take(pa.array(rest)).to_pylist()], pa.list_(pa.int32()))
    all_ = pa.concat_arrays([pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32())), own])
    where = np.empty(len(names), np.int64)
    where[some[unit]] = np.arange(len(unit))
    where[rest] = len(unit) + np.arange(len(rest))
    return all_.take(pa.array(where))


def _decoded(ids: pa.ListArray, model: Pieces) -> tuple[pa.Array, np.ndarray]:
    """What each id of the lists decodes to, and in what byte each list begins."""
    parts = pa.array(model.decoded, pa.large_binary()).take(ids.flatten())
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)])
    return parts, sizes[ids.offsets.to_numpy() - ids.offsets.to_numpy()[0]]


def decode(ids: pa.ListArray, model: Pieces) -> list[str]:
    """Texts of lists of ids."""
    parts, at = _decoded(ids, model)
    joined = parts.buffers()[2] or b""  # taken values lie one after the other
    texts = [str(joined[lo:hi], "utf-8", "replace") for lo, hi in zip(at.tolist(), at[1:].tolist())]
    return [t[1:] if model.prefix and t[:1] == " " else t for t in texts]


def _restored(found: pa.Array, ids: pa.ListArray, model: Pieces) -> np.ndarray:
    """Whether the ids of each unit decode to it."""
    parts, at = _decoded(ids, model)
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), parts.buffers()[2] or pa.py_buffer(b"")])
    return pc.equal(joined, pc.replace_substring(found, SPACE, " ").cast(pa.large_binary())).to_numpy(zero_copy_only=False)


def _encoder(sent, columns: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known_units, known_ids, rules = sent.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found, codes, begin = units(part["text"], model.prefix)
                found = found.cast(pa.string())
                at = pc.index_in(found, value_set=known_units)
                rare = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
                own = encode_many(found.take(pa.array(rare)), model, rules)
                where = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                where[rare] = len(known_ids) + np.arange(len(rare))
                each = pa.concat_arrays([known_ids, own]).take(pa.array(where))
                taken = each.take(pa.array(codes))
                sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False), dtype=np.int64)])
                ids = pa.ListArray.from_arrays(pa.array(sizes[begin].astype(np.int32)), taken.flatten())
                # A text whose units are all restored is; others are decoded whole.
                lost = np.concatenate([[0], np.cumsum(~_restored(found, each, model)[codes])])[begin]
                same = np.diff(lost) == 0
                doubt = pa.array(np.flatnonzero(~same))
                same[~same] = [a == (b or "").replace(SPACE, " ") for a, b in zip(decode(ids.take(doubt), model), part["text"].take(doubt).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in columns), ids, pa.array(same)], [*columns, "ids", "round_trip"])

    return encode


def dictionary(spark: SparkSession, documents: DataFrame, model: Pieces, most: int = DICTIONARY) -> pa.Table:
    """unit, ids of the most frequent units of all documents, `most` at most."""
    counted = documents.select("text").mapInArrow(_count_units(model.prefix), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    counted = stage(spark, counted.where(F.length("unit") <= LONGEST), "units")
    # One row for each different count, which grows with the root of the corpus at most.
    per = counted.groupBy("n").count().orderBy(F.desc("n")).toPandas()
    fit = per["n"][per["count"].cumsum() <= most]
    least = int(fit.min()) if len(fit) else np.iinfo(np.int64).max
    return encode_units(spark, counted.where(F.col("n") >= least), model).toArrow()


def encode(spark: SparkSession, documents: DataFrame, model: Pieces, most: int = DICTIONARY) -> DataFrame:
    """The documents with `ids` and `round_trip` (whether decoding gives the text again)."""
    documents = documents.drop("ids", "round_trip")  # results of an earlier run
    known = dictionary(spark, documents, model, most)
    ids = known["ids"].combine_chunks().cast(pa.list_(pa.int32()))
    units_ = known["unit"].combine_chunks()
    units_, ids = (units_, ids) if len(units_) else (pa.array([], pa.string()), pa.array([], pa.list_(pa.int32())))
    sent = spark.sparkContext.broadcast((model, units_, ids, None if model.unigram else merges(model)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(_encoder(sent, documents.columns), f"{kinds}, ids array<int>, round_trip boolean")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), load())
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")
