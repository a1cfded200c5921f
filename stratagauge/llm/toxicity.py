"""Toxicity by the nearest labelled examples, found exactly with a block-max inverted index.

1. Of the labelled rows (without the held-out fold) at most EXAMPLES of each class, the first by a hash of
   their id, become examples.
2. Terms are words, stems (the first PREFIXES letters of longer words), and stems of several words. Those that stand in toxic examples far
   more often than in clean ones make the vocabulary; their inverse document frequencies come from all documents.
3. Examples and texts are TF-IDF vectors over that vocabulary. A text's K nearest examples by cosine are
   found exactly: blocks of examples are visited by their upper bound until no block can beat the K-th.
4. The score is the share of toxic votes, each weighing cosine^POWER and how many labelled rows its
   example stands for, drawn to the base rate by SMOOTH votes.

Defined results: null texts and texts without a vocabulary term get the toxic share of labelled examples without one; the score depends on
the text alone, so rows that repeat get equal scores; conflicting labels of one doc_id count as toxic; null labels are not
used; without any toxic example all scores are 0; ties among examples go to the smaller doc_id; a null
doc_id is not held out; extra columns are ignored; very long texts are taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import first_by_hash, stage, table
from stratagauge.llm.tokens import slices, words

EXAMPLES, K, POWER, SMOOTH, CUT = 4000, 32, 4, 0.5, 0.7
#: Most terms of the vocabulary; for a term to be in it: toxic examples that hold it, at least, also as a share
#: of all; how many times its rate in clean examples; standard deviations above an even spread.
TERMS, LEAST, SHARE, TIMES, SIGMAS = 4096, 5, 0.02, 4.0, 4.0
PREFIXES = (4, 5, 6)
#: Stems that stand in so many different words of a text are terms of their own.
MANY = (2, 3, 4)
#: Examples in a block of the index.
BLOCK = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def stems_of(word: str) -> list[str]:
    return [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


def terms_of(known: list[str]) -> set[str]:
    """Terms of a text with these distinct words: the words, their stems, and stems of two and of three words or more."""
    stems = Counter(s for w in known for s in stems_of(w))
    return {*known, *stems, *(f"{s}{n}" for s, times in stems.items() for n in MANY if times >= n)}


def _count_examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean examples each term stands."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for part in slices(batch, "text"):
            known, codes, begin = words(part["text"])
            known = known.to_pylist()
            for toxic, lo, hi in zip(part["toxic"].to_pylist(), begin, begin[1:]):
                counts[toxic].update(terms_of([known[c] for c in np.unique(codes[lo:hi])]))
    terms = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])


def vectors(part: pa.RecordBatch, slot: dict[str, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vocabulary terms of each text and how often they stand in it (for stems of many words: in how many words)."""
    wanted = {t.partition("*")[0] + "*" for t in slot if "*" in t}
    known, codes, begin = words(part["text"])
    hits = [[w] * (w in slot) + [s for s in stems_of(w) if s in wanted] for w in known.to_pylist()]
    has = np.fromiter(map(bool, hits), np.bool_, len(hits))
    at = np.flatnonzero(has[codes]) if len(hits) else np.zeros(0, np.int64)
    cuts = np.searchsorted(at, begin)
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        held: dict[int, int] = {}
        own, often = np.unique(codes[at[lo:hi]], return_counts=True)
        stems = Counter(s for c in own for s in hits[c] if s[-1] == "*")
        for c, times in zip(own, often.tolist()):
            for t in hits[c]:
                if t in slot:
                    held[slot[t]] = held.get(slot[t], 0) + times
        for s, times in stems.items():
            held |= {slot[f"{s}{n}"]: times for n in MANY if times >= n and f"{s}{n}" in slot}
        terms = sorted(held)
        out.append((np.array(terms, np.int64), np.array([held[t] for t in terms], np.int64)))
    return out


def _count_documents(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(sent.value), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for part in slices(batch, "text"):
                for terms, _ in vectors(part, sent.value):
                    df[terms] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(df))), pa.array(np.append(n, df))], ["term", "n"])

    return count


def _example_vectors(sent):
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = vectors(part, sent.value)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["toxic"], *(pa.array([x[i].tolist() for x in found], pa.list_(pa.int64())) for i in (0, 1))], ["doc_id", "toxic", "terms", "times"])

    return turn


class BlockMaxIndex:
    """Postings of unit vectors with the largest weight of each term in each block."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n, self.blocks = len(rows), max(1, -(-len(rows) // BLOCK))
        term = np.concatenate([t for t, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])
        weight = np.concatenate([w for _, w in rows] or [np.zeros(0)])
        order = np.lexsort((row, term))
        self.row, self.weight = row[order], weight[order]
        # Postings of term t in block b are those from at[t * blocks + b] on.
        cell = term[order] * self.blocks + self.row // BLOCK
        self.at = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of the largest inner product above 0, ties to the smaller row; exact."""
        bound = weights @ self.most[terms]
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        for block in np.argsort(-bound, kind="stable"):
            # A block whose bound only equals the k-th score may still hold a smaller row.
            if bound[block] <= 0 or (len(scores) == k and bound[block] < scores[-1] - 1e-12):
                break
            own = np.zeros(BLOCK)
            for t, w in zip(terms, weights):
                span = slice(self.at[t * self.blocks + block], self.at[t * self.blocks + block + 1])
                own[self.row[span] - block * BLOCK] += w * self.weight[span]
            hit = np.flatnonzero(own > 0)
            ids, scores = np.append(ids, hit + block * BLOCK), np.append(scores, own[hit])
            top = np.lexsort((ids, -scores.round(12)))[:k]
            ids, scores = ids[top], scores[top]
        return ids, scores


def tf_idf(terms: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(times)) * idf[terms]
    return w / max(np.sqrt((w * w).sum()), 1e-30)


class Model:
    """Vocabulary, index of examples and their votes; its size is bounded by EXAMPLES and TERMS."""

    def __init__(self, slot: dict[str, int], idf: np.ndarray, examples: list[tuple], stands_for: tuple[float, float]):
        self.slot, self.idf = slot, idf
        full = sorted((e for e in examples if len(e[2])), key=lambda e: e[0])
        self.ids = np.array([e[0] for e in full], np.int64)
        self.toxic = np.array([e[1] for e in full], np.float64)
        self.votes = np.array([stands_for[e[1]] for e in full])
        self.index = BlockMaxIndex([(e[2], tf_idf(e[2], e[3], idf)) for e in full], max(1, len(slot)))
        share = lambda some: sum(stands_for[1] for e in some if e[1]) / max(1e-30, sum(stands_for[e[1]] for e in some))
        self.base, self.empty = share(examples), share([e for e in examples if not len(e[2])])

    def score(self, terms: np.ndarray, times: np.ndarray) -> tuple[float, list[int]]:
        if not len(terms):
            return self.empty, []
        rows, near = self.index.nearest(terms, tf_idf(terms, times, self.idf), K)
        w = near**POWER * self.votes[rows]
        pull = SMOOTH * (self.votes[rows].min() if len(rows) else 1)
        return float((w @ self.toxic[rows] + pull * self.base) / (w.sum() + pull)), self.ids[rows[:3]].tolist()


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> Model:
    """Examples, vocabulary and index from labelled rows outside the held-out fold."""
    named = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    named = named.where(~held_out(F.col("doc_id")))
    rows = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["count"] for r in named.groupBy("toxic").count().collect()}
    pick = [first_by_hash(named.where(F.col("toxic") == y), "doc_id", EXAMPLES, rows[y]) for y in (0, 1)]
    chosen = stage(spark, pick[0].unionByName(pick[1]), "chosen-labels")
    # 2 x EXAMPLES rows of two numbers at most.
    examples = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # Copies of one text count once.
    examples = examples.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text", "toxic")
    examples = stage(spark, examples, "examples")
    n = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    counted = examples.mapInArrow(_count_examples, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    expected = (F.col("a") + F.col("b")) * (n[1] / max(1, n[0] + n[1]))
    z = (F.col("a") - expected) / F.sqrt(expected)
    rate = ((F.col("a") + 0.5) / (n[1] + 1)) / ((F.col("b") + 0.5) / (n[0] + 1))
    top = counted.withColumn("z", z).where((F.col("a") >= max(LEAST, SHARE * n[1])) & (rate >= TIMES) & (F.col("z") >= SIGMAS * (max(1, n[0]) / max(1, n[0] + n[1])) ** 0.5))
    slot = {r["term"]: i for i, r in enumerate(top.orderBy(F.desc("z"), "term").limit(TERMS).collect())}
    sent = spark.sparkContext.broadcast(slot)
    df = documents.select("text").mapInArrow(_count_documents(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = dict(zip(df["term"], df["n"]))
    idf = np.log1p(df.get(-1, 1) / np.maximum(1.0, np.array([df.get(i, 0) for i in range(len(slot))] or [1.0])))
    told = examples.mapInArrow(_example_vectors(sent), "doc_id long, toxic int, terms array<long>, times array<long>").toArrow()
    told = [(r["doc_id"], r["toxic"], np.array(r["terms"], np.int64), np.array(r["times"], np.float64)) for r in told.to_pylist()]
    return Model(slot, idf, told, tuple(rows[y] / max(1, n[y]) for y in (0, 1)))


def _scorer(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = sent.value, {}
        for batch in batches:
            for part in slices(batch, "text"):
                found = []
                for terms, times in vectors(part, model.slot):
                    key = (terms.tobytes(), times.tobytes())
                    if key not in seen:
                        if len(seen) > 20_000:
                            seen.clear()
                        seen[key] = model.score(terms, times.astype(np.float64))
                    found.append(seen[key])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return score


def scores(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and evidence (doc_ids of the nearest examples) of every row."""
    sent = spark.sparkContext.broadcast(train(spark, documents, labels))
    return documents.select("doc_id", "text").mapInArrow(_scorer(sent), "doc_id long, score double, evidence array<long>")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "evidence")
