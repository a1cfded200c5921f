"""Fill-in-the-middle transformation of whole documents, and its exact reversal.

Each document is cut at two drawn code points into prefix, middle and suffix, which are put into the order that
its drawn form says, behind the marks <P>, <S> and <M>. No document is put together in a task's memory:

1. `cut` emits pieces of at most PIECE code points, each with its position in the output.
2. `ordered` deals them out by document and sorts them by (document, position): repartition and
   sortWithinPartitions, the DataFrame form of repartitionAndSortWithinPartitions. `_stream` then reads every
   output from its first to its last code point into an incremental digest. From the same stream, and knowing only
   the form, it finds the marks and gives each part its place in the source.
3. Sorting those pieces within the same partitions, without another shuffle, restores the sources in order.

Rows are told apart by where they were read, not by doc_id, and are dealt out by their content and by how many equal rows
the same task had before: so a very frequent row or id is spread over all partitions, and a task that is
run again sends every row where the lost one sent it.

Defined results: a null text counts as an empty one, and empty texts stay plain, as do texts that hold a mark; the draws of
a null doc_id are those of the empty string; rows that repeat, also their ids, are transformed each for itself; very
long texts are taken whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import table

#: Code points of a piece; characters of pieces that a task holds back before it hands them on.
PIECE, HELD = 16_384, 2_000_000
#: Shares in percent: documents that stay plain, and spm among the others.
PLAIN, SPM = 10, 20
# The marks, and the order of the parts (0 prefix, 1 middle, 2 suffix) behind them in each form.
MARKS = ("<P>", "<M>", "<S>")
ORDERS = {"plain": (), "psm": (0, 2, 1), "spm": (2, 0, 1)}

_FACTS = "n long, form string, prefix_chars long, middle_chars long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def plan(doc_id, text: str, seed: int, plain: int = PLAIN, spm: int = SPM) -> tuple[str, int, int]:
    """Form of a document, and the code points where its middle begins and ends."""
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or h[2] % 100 >= 100 - plain or any(mark in text for mark in MARKS):
        return "plain", 0, 0
    return ("spm" if h[3] % 100 < spm else "psm"), low, high


def output_pieces(text: str, form: str, low: int, high: int) -> Iterator[str]:
    """The output of a document from its first to its last code point, in pieces."""
    spans = ((0, low), (low, high), (high, len(text)))
    parts = [(MARKS[p], *spans[p]) for p in ORDERS[form]] or [("", 0, len(text))]
    for mark, first, end in parts:
        yield mark + text[first : min(first + PIECE, end)]
        for at in range(first + PIECE, end, PIECE):
            yield text[at : min(at + PIECE, end)]


class Splitting:
    """Parts of an output that arrives in pieces: finds the marks, of which each stands in it once."""

    def __init__(self, form: str):
        self.waiting = [(MARKS[part], part) for part in reversed(ORDERS[form])]
        self.part, self.tail = 0, ""

    def feed(self, piece: str, last: bool = False) -> Iterator[tuple[int, str]]:
        """(part, text) of what is known to be no mark; a mark's beginning may stand at the end of the input so far."""
        text = self.tail + piece
        while self.waiting and (at := text.find(self.waiting[-1][0])) >= 0:
            if at:
                yield self.part, text[:at]
            mark, self.part = self.waiting.pop()
            text = text[at + len(mark) :]
        keep = len(self.waiting[-1][0]) - 1 if self.waiting and not last else 0
        cut = max(0, len(text) - keep)
        self.tail = text[cut:]
        if cut:
            yield self.part, text[:cut]


class _Rows:
    """Rows on their way out, handed on as batches of bounded size."""

    def __init__(self, schema: str, kinds: dict[str, pa.DataType]):
        self.kinds = [(name, kinds.get(name, pa.int64())) for name in _names(schema)]
        self.rows, self.held = [], 0

    def add(self, size: int, *row) -> bool:
        """Take a row; true when it is time to hand on."""
        self.rows.append(row)
        self.held += size + 64
        return self.held >= HELD

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in self.kinds]
        out = pa.record_batch([pa.array(list(c), kind) for c, (_, kind) in zip(columns, self.kinds)], [n for n, _ in self.kinds])
        self.rows, self.held = [], 0
        return out


def _kinds(doc_id: pa.DataType) -> dict[str, pa.DataType]:
    text = dict.fromkeys(("form", "piece", "output_sha256", "restored_sha256"), pa.string())
    return text | {"doc_id": doc_id, "pos": pa.int64()}


def _cutter(schema: str, seed: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, tag, seen = None, TaskContext.get().partitionId() << 40, Counter()
        for batch in batches:
            out = out or _Rows(schema, _kinds(batch["doc_id"].type))
            for i in range(batch.num_rows):
                doc_id, text = batch["doc_id"][i].as_py(), batch["text"][i].as_py() or ""
                form, low, high = plan(doc_id, text, seed)
                facts = (len(text), form, None, None) if form == "plain" else (len(text), form, low, high - low)
                body = xxhash.xxh3_64_intdigest(text.encode(), seed=xxhash.xxh3_64_intdigest(repr(doc_id).encode()))
                seen[body] += 1
                part = xxhash.xxh3_64_intdigest(b"%d:%d" % (body, seen[body])) - (1 << 63)
                for pos, piece in enumerate(output_pieces(text, form, low, high)):
                    if out.add(len(piece), part, tag, pos, doc_id, *facts, piece):
                        yield out.batch()
                tag += 1
        if out is not None and out.rows:
            yield out.batch()

    return cut


def cut(documents: DataFrame, seed: int = 1) -> DataFrame:
    """Pieces of all outputs: part and tag of the row, pos in its output, doc_id, n, form, prefix_chars, middle_chars, piece."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"part long, tag long, pos long, doc_id {kind}, {_FACTS}, piece string"
    return documents.select("doc_id", "text").mapInArrow(_cutter(schema, seed), schema)


def ordered(pieces: DataFrame) -> DataFrame:
    """Every document's pieces in one partition, in the order of its output."""
    return pieces.repartition("part").sortWithinPartitions("tag", "pos")


def _streamer(schema: str, facts: list[str]):
    """From pieces in output order to pieces with their place in the source; the last row of a document has its facts."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, split, digest, about, n = None, None, None, None, (), 0

        def end() -> bool:
            nonlocal n
            for part, text in split.feed("", last=True):
                out.add(len(text), now, part, n, text, *[None] * (len(facts) + 1))
                n += 1
            return out.add(0, now, len(MARKS), 0, None, digest.hexdigest(), *about)

        for batch in batches:
            out = out or _Rows(schema, _kinds(batch["doc_id"].type))
            columns = [batch[name].to_pylist() for name in ("tag", "piece", *facts)]
            for tag, piece, *own in zip(*columns):
                if tag != now:
                    if now is not None and end():
                        yield out.batch()
                    now, about, n = tag, own, 0
                    split, digest = Splitting(own[facts.index("form")]), hashlib.sha256()
                digest.update(piece.encode())
                for part, text in split.feed(piece):
                    if out.add(len(text), now, part, n, text, *[None] * (len(facts) + 1)):
                        yield out.batch()
                    n += 1
        if now is not None:
            end()
            yield out.batch()

    return stream


def _restorer(schema: str, names: list[str]):
    """From pieces in source order to one row for each document."""

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256()
        for batch in batches:
            out = _Rows(schema, _kinds(batch["doc_id"].type))
            columns = [batch[name].to_pylist() for name in ("part", "piece", *names)]
            for part, piece, *own in zip(*columns):
                if part < len(MARKS):
                    digest.update(piece.encode())
                else:
                    out.add(0, *own, digest.hexdigest())
                    digest = hashlib.sha256()
            yield out.batch()

    return restore


def restored_pieces(documents: DataFrame, seed: int = 1) -> DataFrame:
    """Pieces of all sources, as rebuilt from the outputs, in the order of the source within their partition.

    tag of the row, part (0 prefix, 1 middle, 2 suffix), pos, piece. A last row with part 3 has doc_id, the facts and
    output_sha256 of the document.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"tag long, part long, pos long, piece string, output_sha256 string, doc_id {kind}, {_FACTS}"
    streamed = ordered(cut(documents, seed)).mapInArrow(_streamer(schema, ["doc_id", *_names(_FACTS)]), schema)
    return streamed.sortWithinPartitions("tag", "part", "pos")


def digests(documents: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored source of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_FACTS}, output_sha256 string, restored_sha256 string"
    names = _names(schema)[:-1]
    return restored_pieces(documents, seed).mapInArrow(_restorer(schema, names), schema)


def transformed(documents: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: whole outputs, for texts that fit one value."""
    facts = ["doc_id", *_names(_FACTS)]
    pieces = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    found = cut(documents, seed).groupBy("part", "tag", *facts).agg(pieces.alias("pieces"))
    return found.select(*facts, F.array_join("pieces.piece", "").alias("output"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


OP11_SQL = """
with drawn as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256(concat('1:', coalesce(cast(doc_id as varchar), ''))) as h
  from documents),
numbers as (
  select doc_id, t, n, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as a, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as b,
         ('0x' || substr(h, 17, 8))::bigint % 100 as c, ('0x' || substr(h, 25, 8))::bigint % 100 as d
  from drawn),
cuts as (
  select doc_id, t, n, least(a, b) as low, greatest(a, b) as high,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or c >= 90 then 'plain'
              when d < 20 then 'spm' else 'psm' end as form
  from numbers),
parts as (
  select *, substr(t, 1, low) as prefix, substr(t, low + 1, high - low) as middle, substr(t, high + 1) as suffix from cuts)
select doc_id, n, form,
       case when form <> 'plain' then low end as prefix_chars,
       case when form <> 'plain' then high - low end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
              else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""
