"""Word and shingle hashes of whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes that are worked on at a time; a longer single text is still taken whole.
SLICE = 4_000_000
#: What words are made of.
WORD = r"[\p{L}\p{N}]"
#: An odd multiplier for rolling 64-bit hashes.
P = np.uint64(0x9E3779B97F4A7C15)
#: Whether a character belongs to words; 2: not asked yet.
_KNOWN = np.full(0x110000, 2, np.uint8)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text each.

    After the last one, memory that Arrow holds for later goes back: a worker that waits would keep it beside the heap.
    """
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)
    pa.default_memory_pool().release_unused()


def _in_words(points: np.ndarray) -> np.ndarray:
    """Mask of the code points that belong to words; each is asked for once a process."""
    new = np.unique(points[_KNOWN[points] == 2])
    if len(new):
        _KNOWN[new] = pc.match_substring_regex(pa.array(map(chr, new.tolist()), pa.string()), WORD).to_numpy(zero_copy_only=False)
    return _KNOWN[points] == 1


def _word_bytes(raw: np.ndarray) -> np.ndarray:
    """Mask of the UTF-8 bytes that belong to words."""
    out = (np.zeros(256, np.uint8) + np.append(_in_words(np.arange(128)), np.zeros(128, np.bool_))).astype(np.bool_)[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    first = raw[lead]
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        at = lead[(first >= low) & (first < high)]
        points = raw[at].astype(np.int32) & (0x7F >> size)
        for i in range(1, size):
            points = points << 6 | (raw[at + i] & 0x3F)
        at = at[_in_words(points)]
        for i in range(size):
            out[at + i] = True
    return out


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words, the number of each word in sequence, and where each text begins in that sequence."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    inside = _word_bytes(raw)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(raw))]  # no word crosses from text to text
    starts[edge], ends[edge - 1] = inside[edge], inside[edge - 1]
    starts = np.flatnonzero(starts)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - starts, dtype=np.int64)])
    coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, at)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word in sequence, and where each text begins."""
    known, codes, begin = words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known.cast(pa.large_binary()).to_numpy(zero_copy_only=False)), np.uint64, len(known))
    return hashes[codes] if len(known) else np.zeros(0, np.uint64), begin


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of `size` words; of all words, if there are fewer but some."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    out = hashes[: n - size + 1].copy()
    for i in range(1, size):
        out = out * P + hashes[i : n - size + 1 + i]
    return mixed(out)


def shingles_of_texts(hashes: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of texts whose word hashes stand one after the other, and where each text begins among them."""
    n = np.diff(begin)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(at[-1], np.uint64)
    long = n >= size
    place = np.repeat(begin[:-1][long] - np.concatenate([[0], np.cumsum(counts[long])[:-1]]), counts[long]) + np.arange(counts[long].sum())
    if len(place):
        out[np.repeat(long, counts)] = shingles(hashes, size)[place]
    for i in np.flatnonzero((n > 0) & ~long).tolist():
        out[at[i]] = shingles(hashes[begin[i] : begin[i + 1]], size)[0]
    return out, at
