"""Quality classifier from weak labels.

Nine heuristic labellers vote on each text (bad, good or no vote). Expectation-maximisation over the
counts of all vote patterns, of all documents, estimates how each labeller votes on good and on bad texts,
and with it the probability that a text with a given pattern is good. These posterior labels
train a logistic scorer over hashed shapes of words, line and word repetitions; the scorer decides.

The scorer is fitted on at most SAMPLE documents (the first by a hash of their text); everything else covers all.

Letters, marks, digits and punctuation of all scripts are told apart by their Unicode categories, in all planes.

Defined results: a null text or one without any visible character has score 0 and is rejected; very long texts
are taken whole; the score depends on the text alone, so rows that repeat get equal scores; extra columns stay;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import first_by_hash, stage, table
from stratagauge.llm.tokens import slices

#: Documents the scorer is fitted on at most, hashed features, least score to stay.
SAMPLE, FEATURES, CUT = 8192, 1024, 0.5
#: Texts of the sample that a round of the fit takes at a time.
TOGETHER = 256
#: Share at and above which a labeller says bad, and below which it says good; between them it has no vote.
#: A labeller that knows one kind of bad text never says good (None).
VOTES = {
    "symbols": (0.04, None),  # characters that are neither letters, digits, white space nor common punctuation
    "capitals": (0.35, None),  # letters in upper case
    "bare": (0.15, None),  # tokens without letter or digit
    "shouts": (0.25, None),  # exclamation marks for each token
    "stutter": (0.15, None),  # tokens equal to the one before
    "one_word": (0.25, None),  # the most frequent token
    "echo": (0.50, 0.25),  # runs of three tokens that repeat an earlier one
    "lines": (0.35, None),  # lines that repeat an earlier one
    "odd_words": (0.30, 0.10),  # tokens that are not a word in lower or title case with one common mark at most
}
#: With fewer tokens (or lines, for the last) a share says too little for a vote.
LEAST_TOKENS, LEAST_LINES = 12, 4
# Punctuation of ordinary prose.
PROSE = ".,;:!?'\"()-–—’‘“”«»¿¡…/"
JOINERS = "\u200c\u200d"

_SPACE, _LETTER, _UPPER, _SYMBOL, _BANG = 1, 2, 4, 8, 16


#: Code points from here on are of scripts whose punctuation is that of prose; below, PROSE names what is.
OTHER_SCRIPTS = 0x300
#: General punctuation, of which too PROSE names what is prose.
GENERAL = range(0x2000, 0x2070)


@functools.cache
def _character_classes() -> np.ndarray:
    """Class of every code point; marks that combine with letters belong to them."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c, kind = chr(i), unicodedata.category(chr(i))
        if c.isspace():
            out[i] = _SPACE
        elif c.isalpha():
            out[i] = _LETTER | (_UPPER if c.isupper() else 0)
        elif not (c.isdigit() or kind[0] in "MN" or c in PROSE or c in JOINERS or (kind[0] == "P" and _foreign(i))):
            out[i] = _SYMBOL
    out[ord("!")] |= _BANG
    return out


def _foreign(point: int) -> bool:
    return point >= OTHER_SCRIPTS and point not in GENERAL


def _kind(c: str) -> str:
    """X, x or 9; nothing for what belongs to letters and for punctuation of scripts that set no spaces; else the character."""
    if c.isupper():
        return "X"
    if c.isalpha():
        return "x"
    if c.isdigit():
        return "9"
    kind = "" if c.isascii() else unicodedata.category(c)
    if kind[:1] == "M" or c in JOINERS or (kind[:1] == "P" and _foreign(ord(c))):
        return ""
    return "9" if kind[:1] == "N" else c


class _Kinds(dict):
    """`_kind` of the code points seen so far, for `str.translate`; not more than there are code points."""

    def __missing__(self, point: int) -> str:
        self[point] = kind = _kind(chr(point))
        return kind


_KINDS, _RUN = _Kinds(), re.compile(r"(.)\1+", re.DOTALL)


def _shape(word: str) -> str:
    """Runs of upper case, lower case, digits; other characters as they are, each run once."""
    return _RUN.sub(r"\1", word.translate(_KINDS))


#: Shapes of plain words; the marks are PROSE.
_PLAIN = {"x", "Xx", "9"}


def _odd(shape: str) -> bool:
    return (shape[:-1] if shape[-1:] in PROSE else shape) not in _PLAIN


def _slot(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) % FEATURES


def _repeats(codes: np.ndarray) -> tuple[float, float]:
    """Shares of items equal to an earlier one and of the most frequent item."""
    if not len(codes):
        return 0.0, 0.0
    _, times = np.unique(codes, return_counts=True)
    return 1 - len(times) / len(codes), float(times.max()) / len(codes)


def described(texts: pa.Array, classes: np.ndarray) -> Iterator[tuple[np.ndarray, int, int, np.ndarray, np.ndarray]]:
    """For each text its shares, numbers of tokens and lines, and the slots and values of its features."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    tokens = pc.ascii_split_whitespace(texts)
    flat = tokens.flatten().dictionary_encode()
    codes, at = flat.indices.to_numpy().astype(np.int64), tokens.offsets.to_numpy() - tokens.offsets.to_numpy()[0]
    known = flat.dictionary.to_pylist()
    # Many words have few shapes: what holds for a shape is found once.
    shapes: dict[str, int] = {}
    shape_of = np.fromiter((shapes.setdefault(_shape(w), len(shapes)) for w in known), np.int64, len(known))
    slots = np.array([_slot(f"shape {s}") for s in shapes], np.int64)[shape_of]
    bare = np.array([not any(k in s for k in "xX9") for s in shapes], np.bool_)[shape_of]
    odd = np.array([_odd(s) for s in shapes], np.bool_)[shape_of]
    blank = next((i for i, w in enumerate(known) if w == ""), -1)
    lines = pc.split_pattern(texts, "\n")
    line_codes, line_at = lines.flatten().dictionary_encode(), lines.offsets.to_numpy() - lines.offsets.to_numpy()[0]
    blank_line = pc.index(line_codes.dictionary, pa.scalar("", pa.large_string())).as_py()
    line_codes = line_codes.indices.to_numpy()
    for i, text in enumerate(texts.to_pylist()):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = classes[np.minimum(points, len(classes) - 1)]
        own = codes[at[i] : at[i + 1]]
        own = own[own != blank]
        rows = line_codes[line_at[i] : line_at[i + 1]]
        rows = rows[rows != blank_line]
        n, letters, visible = len(own), np.count_nonzero(kinds & _LETTER), np.count_nonzero(~kinds & _SPACE)
        stutter = np.count_nonzero(own[1:] == own[:-1]) / max(1, n - 1)
        echo = _repeats((own[:-2] * len(known) + own[1:-1]) * len(known) + own[2:])[0] if n > 2 else 0.0
        again, most = _repeats(rows)[0], _repeats(own)[1]
        shares = np.array([
            np.count_nonzero(kinds & _SYMBOL) / max(1, visible), np.count_nonzero(kinds & _UPPER) / max(1, letters),
            np.count_nonzero(bare[own]) / max(1, n), np.count_nonzero(kinds & _BANG) / max(1, n), stutter, most, echo, again, np.count_nonzero(odd[own]) / max(1, n),
        ])
        used, times = np.unique(slots[own], return_counts=True)
        extra = np.array([_slot("stutter"), _slot("echo"), _slot("lines")])
        heavy = np.array([stutter, echo if n >= LEAST_TOKENS else 0, again if len(rows) >= LEAST_LINES else 0])
        yield shares, n, len(rows), np.append(used, extra), np.append(np.sqrt(times / max(1, n)), heavy)


def votes(shares: np.ndarray, n_tokens: int, n_lines: int) -> int:
    """The votes as digits of base 3: 0 no vote, 1 bad, 2 good."""
    code = 0
    for share, (name, (bad, good)) in zip(shares, VOTES.items()):
        vote = 1 if share >= bad else 2 if good is not None and share < good else 0
        enough = n_lines >= LEAST_LINES if name == "lines" else n_tokens >= LEAST_TOKENS
        code = code * 3 + (vote if enough else 0)
    return code


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes = _character_classes()
    for batch in batches:
        for part in slices(batch, "text"):
            rows = list(described(part["text"], classes))
            order = [xxhash.xxh3_64_intdigest(t or "") >> 1 for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(order), pa.array([votes(s, n, k) for s, n, k, _, _ in rows], pa.int32()), pa.array([n for _, n, _, _, _ in rows], pa.int64()),
                 pa.array([x.tolist() for *_, x, _ in rows], pa.list_(pa.int64())), pa.array([x.tolist() for *_, x in rows], pa.list_(pa.float64()))],
                ["hash", "votes", "n", "slots", "values"],
            )


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns. Returns P(good | pattern) and, for each labeller, P(vote | bad or good)."""
    m = len(VOTES)
    digits = (patterns[:, None] // 3 ** np.arange(m - 1, -1, -1)[None, :]) % 3
    good = np.where((digits == 1).any(1), 0.05, 0.95)  # to start with, any bad vote counts
    table_ = np.zeros((m, 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        for v in range(3):
            table_[:, :, v] = (weight @ (digits == v) + 0.5).T
        table_ /= table_.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + sum(np.log(table_[j][:, digits[:, j]]) for j in range(m))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return good, table_


def fit(at: np.ndarray, slots: np.ndarray, values: np.ndarray, target: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Logistic weights (the last one is the bias) for posterior labels; at: where each text's slots and values begin."""
    x = np.zeros((len(target), FEATURES + 1), np.float32)
    np.add.at(x, (np.repeat(np.arange(len(x)), np.diff(at)), slots), values)
    x[:, -1] = 1
    w, speed = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for _ in range(rounds):
        gradient = np.zeros(FEATURES + 1)
        for lo in range(0, len(x), TOGETHER):
            part = x[lo : lo + TOGETHER].astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            gradient += (p - target[lo : lo + TOGETHER]) @ part
        gradient = gradient / max(1, len(x)) + 1e-5 * w
        speed = 0.9 * speed - 1.0 * gradient
        w = w + speed
    return w


def train(spark: SparkSession, documents: DataFrame) -> np.ndarray:
    """Weights of the scorer, from the texts alone."""
    told = stage(spark, documents.select("text").mapInArrow(_describe, "hash long, votes int, n long, slots array<long>, values array<double>"), "described")
    seen = told.where("n > 0").groupBy("votes").count().orderBy("votes").toPandas()  # 3^9 rows at most
    if seen.empty:
        return np.zeros(FEATURES + 1)
    good, _ = estimate(seen["votes"].to_numpy().astype(np.int64), seen["count"].to_numpy().astype(float))
    by_pattern = dict(zip(seen["votes"], good))
    # Slots and values come in the widths that the scorer is fitted with.
    small = [F.col("slots").cast("array<int>"), F.col("values").cast("array<float>")]
    some = first_by_hash(told.where("n > 0"), "hash", SAMPLE, int(seen["count"].sum()), "votes", "n").select("votes", *small).toArrow()
    target = np.array([by_pattern[v] for v in some["votes"].to_pylist()])
    slots, values = (some[name].combine_chunks() for name in ("slots", "values"))
    at = slots.offsets.to_numpy()
    return fit(at - at[0], slots.flatten().to_numpy(), values.flatten().to_numpy(), target)


def _scorer(weights, keep_only: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, classes = weights.value, _character_classes()
        for batch in batches:
            for part in slices(batch, "text"):
                out = np.zeros(part.num_rows)
                for i, (_, n, _, slots, values) in enumerate(described(part["text"], classes)):
                    out[i] = 1 / (1 + np.exp(-np.clip(w[-1] + w[slots] @ values, -30, 30))) if n else 0.0
                if keep_only:
                    yield part.filter(pa.array(out >= CUT))
                else:
                    yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(out)], ["doc_id", "score"])

    return score


def scores(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, score (probability of good), kept of every row."""
    weights = spark.sparkContext.broadcast(train(spark, documents))
    out = documents.select("doc_id", "text").mapInArrow(_scorer(weights, False), "doc_id long, score double")
    return out.withColumn("kept", F.col("score") >= CUT)


def good_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The rows whose text the scorer accepts, with all their columns."""
    weights = spark.sparkContext.broadcast(train(spark, documents))
    return documents.mapInArrow(_scorer(weights, True), documents.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, table(spark, sf_dir, "documents"))
