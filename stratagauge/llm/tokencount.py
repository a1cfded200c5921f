"""Token counts by a finite-state tokenizer compiled from a byte-level BPE vocabulary.

Two deterministic transducers replace the tokenizer:

1. `Splitter`: over classes of code points, it marks where words begin. A batch of texts is one string of classes,
   cut into equal chunks that all step through the transducer at the same time. A chunk's map takes each
   state it may begin in to the state it ends in; a parallel prefix scan composes the maps, which gives every
   chunk its first state, and a second pass writes the marks.
2. `Counter`: over the bytes of a word, every transition is annotated with the change of the number of emitted tokens,
   so the count of a word is the sum along its path. States are made from the vocabulary when a byte first
   leads to them and are kept for the next word. A state holds, for each suffix of the input that begins
   some longer token, the last token before that suffix and the count there: by the merge rules two neighbouring
   tokens stand together exactly if they are not merged when they are encoded alone, so exactly one token may
   come last, and nothing else about the input matters later.

Each distinct word of a batch takes its path once. Classes are asked from the library itself, code point by code point.

Defined results: a null text counts as an empty one (no bytes, no tokens); a special token's string inside a text is one token,
as the library reads it; rows that repeat, also their ids, are counted each for itself; a null doc_id stays null; very
long texts are taken whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from stratagauge.llm.common import table
from stratagauge.llm.tokens import slices

VOCABULARY = "byte_bpe_50k.json"
#: A document of more tokens is over the limit.
LIMIT = 1024
#: Text bytes that are split at a time; a longer text is still taken whole.
SLICE = 2_000_000
#: Code points of a chunk that steps through the splitter.
CHUNK = 256
#: Words, states and pairs of tokens that a task keeps; when there are more, they are forgotten and made again.
KEPT_WORDS, KEPT_STATES, KEPT_PAIRS = 250_000, 80_000, 300_000

# Classes of code points. Letters that end or go on a contraction have classes of their own.
BREAK, LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE, ENDS, R, V, L, E = range(12)
CLASSES = 12
# States of the splitter: what the input so far ends in.
(AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_WHITE, LAST_SPACE, LAST_WHITE, QUOTED, QUOTE_R, QUOTE_V, QUOTE_L) = range(12)
STATES = 12


def _step(state: int, kind: int) -> tuple[int, bool, bool]:
    """Next state; whether a word begins at this code point; whether one begins at the code point before it.

    Words are an apostrophe with s, t, m, d, re, ve or ll; or a run of letters, numbers or other signs, each
    with one space before it; or white space, which leaves its last character to what follows.
    """
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (L if state == QUOTE_L else E):
            return AT_START, False, False
        # No contraction: the apostrophe is a word, and the letter after it begins another.
        after, here, _ = _step(IN_LETTERS, kind)
        return after, here, True
    if kind == BREAK:
        return AT_START, True, False
    if kind in (SPACE, WHITE):
        if state in (ONE_SPACE, ONE_WHITE, LAST_SPACE, LAST_WHITE):
            return (LAST_SPACE if kind == SPACE else LAST_WHITE), False, False
        return (ONE_SPACE if kind == SPACE else ONE_WHITE), True, False
    run = {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}.get(kind, IN_LETTERS)
    if state == ONE_SPACE:
        return run, False, False
    if state == LAST_SPACE:
        return run, False, True
    if state == QUOTED:
        if kind in (R, V, L):
            return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], False, False
        if kind == ENDS:
            return AT_START, False, False
        return run, run != IN_OTHERS, False
    if state == run:
        return run, False, False
    return (QUOTED if kind == QUOTE else run), True, state == LAST_WHITE


@dataclass
class Splitter:
    """The compiled splitting transducer: class of each code point, next state and marks by state and class."""

    kinds: np.ndarray
    following: np.ndarray = field(init=False)
    marks: np.ndarray = field(init=False)

    def __post_init__(self):
        steps = [_step(s, k) for s in range(STATES) for k in range(CLASSES)]
        self.following = np.array([s for s, _, _ in steps], np.uint8)
        self.marks = np.array([here + 2 * before for _, here, before in steps], np.uint8)

    def begins(self, kinds: np.ndarray) -> np.ndarray:
        """Mask of the positions where a word begins; the input starts and ends at a BREAK."""
        n = len(kinds)
        chunks = -(-n // CHUNK)
        grid = np.zeros(chunks * CHUNK, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
        first = prefix_states(self.chunk_maps(grid))
        written = np.empty_like(grid)
        state = first
        for row, kind in enumerate(grid):
            at = state * np.uint8(CLASSES) + kind
            written[row] = self.marks[at]
            state = self.following[at]
        written = written.T.ravel()[:n]
        out = (written & 1).astype(bool)
        out[:-1] |= (written[1:] & 2).astype(bool)
        return out

    def chunk_maps(self, grid: np.ndarray) -> np.ndarray:
        """State at the end of each chunk for each state at its start."""
        state = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (grid.shape[1], STATES)).copy()
        alike = np.zeros(0, np.int64)
        for row, kind in enumerate(grid):
            # Once a chunk's states have met, they stay together: most need a few steps only.
            if row in (8, 16, 32, 64):
                alike = np.flatnonzero((state == state[:, :1]).all(1))
                if len(alike) == len(state):
                    return np.repeat(self._run(state[:, 0], grid[row:])[:, None], STATES, 1)
                if row == 64:
                    break
            state = self.following[state * np.uint8(CLASSES) + kind[:, None]]
        else:
            return state
        apart = np.setdiff1d(np.arange(len(state)), alike)
        out = np.repeat(self._run(state[:, 0], grid[row:])[:, None], STATES, 1)
        rest = state[apart]
        for kind in grid[row:, apart]:
            rest = self.following[rest * np.uint8(CLASSES) + kind[:, None]]
        out[apart] = rest
        return out

    def _run(self, state: np.ndarray, grid: np.ndarray) -> np.ndarray:
        for kind in grid:
            state = self.following[state * np.uint8(CLASSES) + kind]
        return state


def prefix_states(maps: np.ndarray, first: int = AT_START) -> np.ndarray:
    """State before each chunk: a prefix scan over the composition of the chunks' maps.

    Every round doubles the chunks that a map spans, all chunks at the same time.
    """
    spans, reach = maps.copy(), 1
    while reach < len(spans):
        # First the earlier span, then the own one.
        spans[reach:] = np.take_along_axis(spans[reach:], spans[:-reach].astype(np.int64), 1)
        reach *= 2
    return np.concatenate([[first], spans[:-1, first]]).astype(np.uint8)


@dataclass
class Vocabulary:
    """What the counting transducer is compiled from: a tree over the tokens' bytes, and the merges by rank."""

    #: (node, byte) as node * 256 + byte -> node below; token at a node or -1; whether a node has others below.
    below: dict[int, int]
    token: list[int]
    inner: list[bool]
    bytes_: list[bytes]
    ranks: dict[tuple[bytes, bytes], int]

    def merged(self, text: bytes, edge: int = 0) -> list:
        """The tokens of a short string: the merge of the lowest rank first, the leftmost of equal ones.

        With an edge (-1 or 1) what its first or last token was in turn, as (token, when it was formed).
        """
        parts, history, now = [text[i : i + 1] for i in range(len(text))], [], -1
        while True:
            at = 0 if edge < 0 else len(parts) - 1
            if edge and parts and (not history or history[-1][0] != parts[at]):
                history.append((parts[at], now))
            ranked = [(self.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
            if not ranked:
                return history if edge else parts
            rank, i = min(ranked)
            now = max(now, rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


def vocabulary(model: dict) -> Vocabulary:
    """The tree and the merges of a byte-level BPE model as its JSON file has them."""
    back = {c: b for b, c in byte_signs().items()}
    raw = lambda token: bytes(back[c] for c in token)
    out = Vocabulary({}, [-1], [False], [], {})
    for token in model["vocab"]:
        if any(c not in back for c in token):
            continue  # a special token's string
        node, key = 0, raw(token)
        for b in key:
            if (node << 8 | b) not in out.below:
                out.below[node << 8 | b] = len(out.token)
                out.inner[node] = True
                out.inner.append(False)
                out.token.append(-1)
            node = out.below[node << 8 | b]
        out.token[node] = len(out.bytes_)
        out.bytes_.append(key)
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        out.ranks.setdefault((raw(a), raw(b)), rank)
    return out


def byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte in a byte-level vocabulary: its own, or the next beyond 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Counter:
    """The counting transducer: from a state, a byte leads to a state and changes the number of tokens."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self._edges: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self._together: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        # A state: for each suffix, longest first, (tree node, last token before it, its count less the count now).
        self.states: list[tuple] = [((0, -1, 0),)]
        self.ids: dict[tuple, int] = {self.states[0]: 0}
        #: state * 256 + byte -> (next state, change of the count); of a word's last byte the change alone.
        self.steps: dict[int, tuple[int, int]] = {}
        self.ends: dict[int, int] = {}

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """What stood at one end of a token while it was formed: (part, formed, taken up by the next)."""
        if (found := self._edges.get((token, side))) is None:
            parts = self.words.merged(self.words.bytes_[token], side)
            gone = [when for _, when in parts[1:]] + [1 << 62]
            found = self._edges[token, side] = [(part, when, end) for (part, when), end in zip(parts, gone)]
        return found

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether token b may follow token a, which is -1 at the start of a word.

        They may not if some part at the end of a and some part at the start of b stood side by side when
        their merge had its turn; of merges of one rank the one further left has it first.
        """
        if a < 0:
            return True
        if (found := self._together.get(a << 20 | b)) is None:
            if len(self._together) > KEPT_PAIRS:
                self._together.clear()
            ranks, found = self.words.ranks, True
            for right, formed, gone in self._edge(b, -1):
                for left, formed_, gone_ in self._edge(a, 1):
                    rank = ranks.get((left, right))
                    if rank is not None and max(rank, formed, formed_) < gone_ and max(rank, formed, formed_) <= gone:
                        found = False
            self._together[a << 20 | b] = found
        return found

    def end(self, state: int, byte: int) -> int:
        """The change of the count at a word's last byte."""
        below, token, together = self.words.below, self.words.token, self._together
        for node, before, count in self.states[state]:
            child = below.get(node << 8 | byte)
            if child is not None and (last := token[child]) >= 0:
                if before < 0 or ((apart := together.get(before << 20 | last)) is None and self.stay_apart(before, last)) or apart:
                    self.ends[state << 8 | byte] = count + 1
                    return count + 1
        raise ValueError("this vocabulary does not cover every byte")

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and the change of the count, compiled at the first call."""
        below, token, inner = self.words.below, self.words.token, self.words.inner
        last, now, going = -1, 0, []
        for suffix in self.states[state]:
            child = below.get(suffix[0] << 8 | byte)
            if child is None:
                continue
            if last < 0 and token[child] >= 0 and self.stay_apart(suffix[1], token[child]):
                last, now = token[child], suffix[2] + 1
            if inner[child]:
                going.append((child, suffix[1], suffix[2]))
        if last < 0:
            raise ValueError("this vocabulary does not cover every byte")
        if now:
            going = [(node, before, count - now) for node, before, count in going]
        going.append((0, last, 0))
        key = tuple(going)
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
        out = self.steps[state << 8 | byte] = found, now
        return out

    def count(self, word: bytes) -> int:
        """Tokens of a word of any length: the sum of the changes along its path."""
        if len(self.ids) > KEPT_STATES or len(self.ends) > KEPT_PAIRS:
            self._forget()
        steps, state, total = self.steps, 0, 0
        for byte in word[:-1]:
            found = steps.get(state << 8 | byte)
            if found is None:
                if len(self.ids) > 2 * KEPT_STATES:  # one very long word: only the state it is in stays
                    own = self.states[state]
                    self._forget()
                    steps, state = self.steps, self.ids.setdefault(own, 1)
                    self.states += [own] * state
                found = self.step(state, byte)
            state, now = found
            total += now
        byte = word[-1]
        if (found := steps.get(state << 8 | byte)) is not None:
            return total + found[1]
        now = self.ends.get(state << 8 | byte)
        return total + (self.end(state, byte) if now is None else now)


@dataclass
class Compiled:
    """A tokenizer file compiled to its two transducers and its special tokens."""

    splitter: Splitter
    counter: Counter
    specials: list[bytes]
    known: dict[bytes, int] = field(default_factory=dict)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (no nulls)."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = (data or pa.py_buffer(b"")).slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        raw = np.frombuffer(data, np.uint8)
        begins, whole = self._begins(raw, data, offsets)
        if not len(begins):
            return np.zeros(len(texts), np.int64)
        edges = np.append(begins, len(raw))
        words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges), data]).dictionary_encode()
        known, codes = words.dictionary.to_pylist(), words.indices.to_numpy()
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        per = np.empty(len(known), np.int64)
        for i, word in enumerate(known):
            n = self.known.get(word)
            if n is None:
                n = self.counter.count(word)
                if len(word) <= 64:
                    self.known[word] = n
            per[i] = n
        tokens = per[codes]
        tokens[np.searchsorted(begins, whole)] = 1
        total = np.concatenate([[0], np.cumsum(tokens)])
        at = np.searchsorted(begins, offsets)
        return total[at[1:]] - total[at[:-1]]

    def _begins(self, raw: np.ndarray, data: pa.Buffer, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte where each word begins, over all texts; and those where a special token does."""
        leads = np.flatnonzero((raw & 0xC0) != 0x80)
        points = np.frombuffer(data.to_pybytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kinds = self.splitter.kinds[points]
        inside = self._special(data.to_pybytes(), offsets)
        cuts = np.unique(np.concatenate([offsets, inside.ravel()]))
        # A break before the first code point of each text, and around special tokens.
        at = np.searchsorted(leads, cuts)
        mask = self.splitter.begins(np.append(np.insert(kinds, at, BREAK), np.uint8(BREAK)))
        places = at + np.arange(len(at))
        mask = np.delete(mask[:-1], places)
        begins = leads[mask]
        if len(inside):
            span = np.searchsorted(inside[:, 0], begins, "right") - 1
            covered = (span >= 0) & (begins > inside[span, 0]) & (begins < inside[span, 1])
            begins = begins[~covered]
        return begins.astype(np.int64), inside[:, 0]

    def _special(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """First and last byte (exclusive) of special tokens: leftmost first, the longest of those; none across texts."""
        found = []
        for token in self.specials:
            at = data.find(token)
            while at >= 0:
                end = at + len(token)
                if offsets[np.searchsorted(offsets, at, "right")] >= end:
                    found.append((at, end))
                at = data.find(token, at + 1)
        kept, last = [], 0
        for at, end in sorted(found, key=lambda span: (span[0], -span[1])):
            if at >= last:
                kept.append((at, end))
                last = end
        return np.array(kept, np.int64).reshape(-1, 2)


def code_point_kinds(tokenizer: Tokenizer) -> np.ndarray:
    """Class of every code point as the tokenizer's own splitting treats it."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, OTHER, np.uint8)
    for lo in range(0, 0x110000, 256):
        if 0xD800 <= lo < 0xE000:
            continue  # surrogates are in no text
        block = "".join(map(chr, range(lo, lo + 256)))
        # A stretch that the tokenizer keeps together is of one class, that of its last code point: the one whose run it goes on.
        for _, (first, end) in split(block):
            joined = [kind for kind, sign in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(sign + block[end - 1])) == 1]
            kinds[lo + first : lo + end] = joined[0] if joined else WHITE
    signs = {" ": SPACE, "'": QUOTE, "s": ENDS, "t": ENDS, "m": ENDS, "d": ENDS, "r": R, "v": V, "l": L, "e": E}
    for sign, kind in signs.items():
        kinds[ord(sign)] = kind
    return kinds


#: Compiled tokenizers of this process by the content of their files.
_compiled: dict[int, Compiled] = {}


def read_file(path: str) -> tuple[str, bytes]:
    """A tokenizer file and the classes of code points: what a task compiles its transducers from (both bounded)."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    kind = json.loads(text)
    splits = kind.get("pre_tokenizer") or {}
    plain = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
    model = kind["model"]
    odd = [n for n in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(n)]
    if not plain or kind.get("normalizer") or model.get("type") not in (None, "BPE") or odd:
        raise ValueError("only byte-level BPE files without normalizer can be compiled")
    if any(t.get(n) for t in kind.get("added_tokens", []) for n in ("single_word", "lstrip", "rstrip")):
        raise ValueError("special tokens that take white space or whole words are not compiled")
    return text, code_point_kinds(Tokenizer.from_str(text)).tobytes()


def compiled(text: str, kinds: bytes) -> Compiled:
    """The transducers, made once in a process."""
    key = hash(text)
    if key not in _compiled:
        kind = json.loads(text)
        specials = [t["content"].encode() for t in kind.get("added_tokens", [])]
        _compiled[key] = Compiled(Splitter(np.frombuffer(kinds, np.uint8)), Counter(vocabulary(kind["model"])), specials)
    return _compiled[key]


def _counter(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(*sent.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = pc.fill_null(part["text"], "")
                sizes = pc.cast(pc.binary_length(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], sizes, pa.array(machine.counts(texts))], ["doc_id", "n_bytes", "n_tokens"])

    return count


def token_counts(spark: SparkSession, documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, by the tokenizer file at `path` (read on the driver)."""
    sent = spark.sparkContext.broadcast(read_file(path))
    kind = documents.schema["doc_id"].dataType.simpleString()
    counted = documents.select("doc_id", "text").mapInArrow(_counter(sent), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", counted["n_tokens"] > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
