"""Fill-in-the-middle, conversation repair and token counts: odd rows, and brute-force versions on small tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratagauge.llm import conversations, fim, tokencount
from tests.llm.test_documents import documents, prose

SIGNS = "abc <>PSM'stredvl\n 0é日🙂.!?"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, repeated and very long texts, marks, a null id, columns with clashing names."""
    rng = random.Random(4)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " ", "x", "<P>", "a<S", "<<M", "<|endoftext|>a<|endoftext", prose(1, 20_000), "日" * 40_000, "a" * 50_000]
    rows = [(i, text, "a") for i, text in enumerate(texts)]
    rows += [(None, prose(2, 40), "b"), (5, prose(3, 40), None), (5, prose(3, 40), None), (5, prose(4, 40), None)]
    return documents(spark, rows)


# --- Fill in the middle ----------------------------------------------------------------------


def fim_by_hand(doc_id, text):
    text = text or ""
    n, h = len(text), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_equals_the_plain_version(odd, rows):
    expected = [fim_by_hand(r.doc_id, r.text) for r in odd.collect()]
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    assert rows(fim.transformed(odd)) == sorted(expected, key=repr)
    texts = [r.text or "" for r in odd.collect()]
    digests = [(*e[:-1], sha(e[-1]), sha(t)) for e, t in zip(expected, texts)]
    assert rows(fim.digests(odd)) == sorted(digests, key=repr)
    assert fim.digests(odd.limit(0)).collect() == [] and fim.transformed(odd.limit(0)).collect() == []


def test_pieces_restore_the_source(odd):
    long = odd.where("length(text) > 30000")
    pieces = fim.restored_pieces(long)
    found = pieces.where("part < 3").groupBy("tag").agg(F.array_sort(F.collect_list(F.struct("part", "pos", "piece"))).alias("p"))
    texts = sorted("".join(x.piece for x in r.p) for r in found.collect())
    assert texts == sorted(r.text for r in long.collect())
    assert pieces.agg(F.max(F.length("piece"))).first()[0] <= fim.PIECE + 3


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_marks_are_found_across_pieces(size):
    for text in ("", "<", "<P", "<S<", "a<P<Sb", "<M"):
        for form, output in (("psm", f"<P>{text}<S>{text}<M>{text}"), ("spm", f"<S>{text}<P>{text}<M>{text}")):
            split, parts = fim.Splitting(form), ["", "", ""]
            for at in range(0, len(output), size):
                for part, piece in split.feed(output[at : at + size]):
                    parts[part] += piece
            for part, piece in split.feed("", last=True):
                parts[part] += piece
            assert parts == [text] * 3


def test_repeated_rows_are_spread_over_the_partitions(spark):
    same = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some text").alias("text")).coalesce(1)
    parts = fim.cut(same).where("pos = 0").groupBy(F.pmod(F.hash("part"), F.lit(4))).count().collect()
    assert sorted(n > 400 for _, n in parts) == [True] * 4
    again = fim.cut(same).select("part").collect()
    assert sorted(again) == sorted(fim.cut(same.repartition(1)).select("part").collect())


# --- Conversation repair ---------------------------------------------------------------------


def cheapest(rows):
    """Lowest cost, least audit and the repaired rows, over all audits of few rows (initial, must go, broken)."""
    best = None
    options = [[("D", None)] if must else [(e, r) for e, r in (("D", None), ("K", i), ("R", "u"), ("R", "a"))] for i, must, _ in rows]
    for chosen in itertools.product(*options):
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            audit, roles, cost = "I" * len(gaps[0]), gaps[0], 5 * len(gaps[0])
            for (edit, role), (_, _, broken), gap in zip(chosen, rows, gaps[1:]):
                audit, roles = audit + edit + "I" * len(gap), roles + (role or "") + gap
                cost += {"D": 2, "K": 5 * broken, "R": 1 + 5 * broken}[edit] + 5 * len(gap)
            if re.fullmatch("(s?(ua)+)?", roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def run_repair(rows, window=None):
    repair, settled = conversations.Repair(), ""
    for i, row in enumerate(rows):
        repair.row(*row)
        if window and i % window == 0:
            settled += repair.settle()
    cost, rest = repair.end()
    return cost, settled + rest


def test_repair_finds_the_least_of_the_cheapest_audits():
    rng = random.Random(8)
    for _ in range(250):
        rows = [(rng.choice([*"suax", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 3))]
        assert run_repair(rows) == cheapest(rows)


def test_settling_changes_nothing_and_bounds_what_is_kept():
    rng = random.Random(9)
    for _ in range(60):
        rows = [(rng.choice([*"ssuuuaaax", ""]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(0, 120))]
        assert run_repair(rows) == run_repair(rows, 1) == run_repair(rows, 7)
    repair = conversations.Repair()
    for i in range(5000):
        repair.row(rng.choice("uuaas"), rng.random() < 0.1, rng.random() < 0.1)
        if i % 50 == 49:
            repair.settle()
            assert max(last.depth if last else 0 for _, last in repair.best.values()) < 100


def test_equal_hashes_are_verified(monkeypatch):
    rng = random.Random(10)
    rows = [[(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(25)] for _ in range(30)]
    expected = [run_repair(r) for r in rows]
    for modulus in (1, 3, 17):
        monkeypatch.setattr(conversations, "_MODULUS", modulus)
        assert [run_repair(r) for r in rows] == expected


def test_common_prefix_and_order_of_audits():
    rng = random.Random(11)
    made = [None]
    for _ in range(400):
        made.append(conversations.Edit(rng.choice(made), rng.choice("DK")))
    for _ in range(3000):
        a, b = rng.choice(made), rng.choice(made)
        one, two = conversations.signs(a), conversations.signs(b)
        n = next((i for i, (p, q) in enumerate(zip(one, two)) if p != q), min(len(one), len(two)))
        assert conversations.common(a, b) == n
        if not (one + "I").startswith(two):
            assert conversations.less(a, "I", b) == (one + "I" < two)


def conversation_by_hand(conv_id, rows):
    """The row that the contract asks for, from the damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen, steps = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        inked = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not inked else "duplicate" if (role, text) in seen else "truncated" if inked[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(steps) if len(steps) <= 3 else run_repair(steps)
    left, lines, role_now = iter(rows), [], ""
    for edit in audit:
        _, role, text = next(left) if edit != "I" else (None, None, "")
        if edit == "D":
            continue
        if edit == "K" and not role_now and role[:1] == "s":
            role_now = "s"
        elif edit != "K" or role:
            role_now = "a" if role_now == "u" else "u"
            role = role if edit == "K" else {"u": "user", "a": "assistant"}[role_now]
        lines.append(f"{role}:{text}")
    return conv_id, gaps, *faults.values(), illegal, cost, audit, sha("\n".join(lines))


def damage_by_hand(conv_id, turn, role, text):
    import zlib

    role, text = " " if role is None else role, " " if text is None else text
    draw = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
    rows = [(turn, "user" if draw == 4 else role, text)]
    return [] if draw == 0 else rows * 2 if draw == 3 else rows


def test_conversations_equal_the_plain_version(spark, rows):
    rng = random.Random(12)
    texts = ["Yes.", "No!", "Why?", "broken off", "", " \n", None, "Done. \t", "é?", "x" * 100_000 + "."]
    table = []
    for conv_id in [*range(400), None]:
        for _ in range(rng.randint(1, 5)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            table.append((conv_id, rng.choice([None, 0, 1, 2, 3, 7, -2]), role, rng.choice(texts), 1, True, "x", True))
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, copy int, alive boolean, body string, repeated boolean")
    per = {}
    for conv_id, turn, role, text, *_ in table:
        per.setdefault(conv_id, []).extend(damage_by_hand(conv_id, turn, role, text))
    expected = sorted((conversation_by_hand(c, r) for c, r in per.items()), key=repr)
    assert rows(conversations.audits(conversations.damaged(df))) == expected
    assert any(not r for r in per.values())
    assert conversations.audits(conversations.damaged(df.limit(0))).collect() == []

    edits = conversations.edits(conversations.damaged(df)).collect()
    audits = {}
    for e in sorted(edits, key=lambda e: e.position):
        audits[e.conv_id] = audits.get(e.conv_id, "") + e.edit
    assert audits == {row[0]: row[-2] for row in expected if row[-2]}


def test_a_long_conversation_is_streamed(spark):
    n = 6000
    df = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.expr("case when id % 7 = 3 then 'user' when id % 2 = 0 then 'user' else 'assistant' end").alias("role"),
        F.concat(F.lit("Line "), (F.col("id") % 5000).cast("string"), F.lit(".")).alias("text"),
    )
    found = conversations.audits(df.withColumn("alive", F.lit(True))).collect()
    steps = [("u" if i % 7 == 3 or i % 2 == 0 else "a", False, False) for i in range(n)]
    seen = {}
    for i in range(n):
        key = (steps[i][0], i % 5000)
        steps[i] = (steps[i][0], key in seen, False)
        seen[key] = True
    assert [(r.cost, r.audit) for r in found] == [run_repair(steps)]
    assert found[0].duplicate == sum(must for _, must, _ in steps) > 0


# --- Token counts ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path(tokencount.VOCABULARY)
    return path, Tokenizer.from_file(path), tokencount.compiled(*tokencount.read_file(path))


def library_counts(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(vocabulary):
    _, tokenizer, machine = vocabulary
    rng = random.Random(13)
    signs = [*"abcdelrvstm'' \n\t  !?.,0129éß日本語한ñ　 \u0085\x1c🙂", "<|endoftext|>", "'re", "'ll", "'ve", "'s", "<|endof"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x7E), rng.randint(0x80, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(1000)]
    texts += ["", " ", "<|endoftext|>", "a" * 5000, "1" * 777, " " * 3000, "\n" * 999 + "x", "ab" * 3000, "日本" * 2000, prose(5, 3000)]
    assert machine.counts(pa.array(texts)).tolist() == library_counts(tokenizer, texts)


def test_tokens_stay_apart_as_when_encoded_alone(vocabulary):
    words, counter = vocabulary[2].counter.words, vocabulary[2].counter
    rng = random.Random(14)
    for _ in range(5000):
        a, b = rng.randrange(len(words.bytes_)), rng.randrange(2000)
        left, right = words.bytes_[a], words.bytes_[b]
        assert counter.stay_apart(a, b) == (words.merged(left + right) == [left, right])


def test_chunk_maps_compose_to_the_states_of_one_run(vocabulary):
    splitter = vocabulary[2].splitter
    rng = np.random.default_rng(15)
    for n in (1, 255, 256, 257, 5000):
        kinds = rng.integers(0, tokencount.CLASSES, n).astype(np.uint8)
        kinds[rng.random(n) < 0.3] = tokencount.QUOTE
        state, marks = tokencount.AT_START, np.zeros(n + 1, bool)
        for i, kind in enumerate(kinds):
            state, here, before = tokencount._step(state, int(kind))
            marks[i] |= here
            marks[i - 1] |= before
        assert (splitter.begins(kinds) == marks[:n]).all()


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    path, tokenizer, _ = vocabulary
    for name in ("KEPT_WORDS", "KEPT_STATES", "KEPT_PAIRS"):
        monkeypatch.setattr(tokencount, name, 5)
    text, kinds = tokencount.read_file(path)
    machine = tokencount.Compiled(tokencount.Splitter(np.frombuffer(kinds, np.uint8)), tokencount.Counter(vocabulary[2].counter.words), [])
    texts = [prose(6, 300), "antidisestablishmentarianism" * 30, "日本語" * 50]
    for _ in range(2):
        assert machine.counts(pa.array(texts)).tolist() == library_counts(tokenizer, texts)


def test_token_counts_of_odd_rows(spark, odd, rows, vocabulary):
    path, tokenizer, _ = vocabulary
    expected = []
    for r in odd.collect():
        n = library_counts(tokenizer, [r.text or ""])[0]
        expected.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    found = tokencount.token_counts(spark, odd, path)
    assert rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert {e[3] for e in expected} == {True, False}
    assert tokencount.token_counts(spark, odd.limit(0), path).collect() == []


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokencount.read_file(public_tokenizers.path("word_bpe_49k.json"))
