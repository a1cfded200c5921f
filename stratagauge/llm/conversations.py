"""Repair of broken conversations by the cheapest edits, with the edits as an audit.

A conversation has to read system? (user assistant)+, or be empty. Its rows are streamed in order through a dynamic
program over four states (what the kept roles end in). For each state it keeps the lowest cost and, of
the audits with that cost, the one that is least in ASCII. Audits are persistent: an edit is a node that points to
the edit before it, so all states share their common beginnings, and a step costs the same however long
the audit is. A node knows its depth, a rolling hash of the audit up to it and its ancestors at distances 1, 2, 4, ...;
audits of equal cost are compared by searching their longest common prefix over these ancestors,
and equal hashes are verified edit by edit. (Audits of equal cost to one state never are prefixes of one another,
since they differ by insertions, which cost; so the least beginning stays the least when edits follow.)

Rows are dealt out by conversation and sorted by turn in Spark, and repeated rows are found by a group-by; a task
holds only the edits and rows on which the states still disagree. What they agree on is settled, put out and
forgotten every WINDOW rows, so a conversation of any length streams through. It does pass through one task,
since the digest of its text has to read it in order.

Defined results: null roles and texts are one space, as is a null conv_id or turn where rows are drawn; rows with one turn go by
role, then text; a null turn is before all others; a null conv_id is a conversation too; a role without characters has no initial and may stay anywhere;
a conversation that loses all rows has an empty audit; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import table
from stratagauge.operators.joins import left_lookup

#: Costs of the edits, and of keeping a text that breaks off.
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
#: Rows after which what all states agree on is put out.
WINDOW = 1024
#: Characters of rows that are held back before they are handed on.
HELD = 2_000_000
WHITE = " \t\n\x0b\x0c\r"
_BASE, _MODULUS = 1_000_003, (1 << 61) - 1

# States: nothing kept yet, or what the last kept role is.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant row, kept, changed or inserted, leads.
AFTER = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
INITIALS = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}


class Edit:
    """The last edit of an audit; None is the audit without edits."""

    __slots__ = ("sign", "depth", "hash", "above")

    def __init__(self, before: Edit | None, sign: str):
        self.sign = sign
        self.depth = before.depth + 1 if before else 1
        self.hash = ((before.hash if before else 0) * _BASE + ord(sign)) % _MODULUS
        #: The edits 1, 2, 4, ... before this one.
        self.above: list[Edit | None] = [before]
        while (far := self.above[-1]) is not None and len(far.above) >= len(self.above):
            self.above.append(far.above[len(self.above) - 1])

    def at(self, depth: int) -> Edit:
        """The edit of this audit at a depth from 1 to its own."""
        here, back = self, self.depth - depth
        while back:
            step = back.bit_length() - 1
            here, back = here.above[step], back - (1 << step)
        return here


def signs(last: Edit | None) -> str:
    out = []
    while last is not None:
        out.append(last.sign)
        last = last.above[0]
    return "".join(reversed(out))


def _same(a: Edit | None, b: Edit | None) -> bool:
    """Whether audits of one depth are equal, edit by edit up to the first that they share."""
    while a is not b:
        if a.sign != b.sign:
            return False
        a, b = a.above[0], b.above[0]
    return True


def common(a: Edit | None, b: Edit | None) -> int:
    """Length of the longest common prefix of two audits."""
    if a is None or b is None:
        return 0
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x is y:
        return depth
    if x.hash != y.hash:
        # As far back as the hashes differ; then the audits before are equal, and these edits differ.
        for step in range(len(x.above) - 1, -1, -1):
            if step < len(x.above):
                far, other = x.above[step], y.above[step]
                if far is not other and far.hash != other.hash:
                    x, y = far, other
        if x.sign != y.sign and _same(x.above[0], y.above[0]):
            return x.depth - 1
    elif _same(x, y):
        return depth
    # Hashes collided: compare the audits themselves.
    one, two = signs(a), signs(b)
    return next((i for i, (p, q) in enumerate(zip(one, two)) if p != q), depth)


def less(a: Edit | None, sign: str, b: Edit | None) -> bool:
    """Whether audit a with one more edit comes before audit b, which is not a prefix of it."""
    n = common(a, b)
    mine = a.at(n + 1).sign if a is not None and a.depth > n else sign
    return b is not None and b.depth > n and mine < b.at(n + 1).sign


class Repair:
    """The dynamic program over the rows of one conversation."""

    def __init__(self):
        #: State -> (cost, last edit); states that cannot be reached, or can no longer win, are left out.
        self.best: dict[int, tuple[int, Edit | None]] = {NOTHING: (0, None)}
        self._insert()

    @staticmethod
    def _offer(best: dict, state: int, cost: int, before: Edit | None, sign: str) -> bool:
        known = best.get(state)
        if known is None or cost < known[0] or (cost == known[0] and less(before, sign, known[1])):
            best[state] = (cost, Edit(before, sign))
            return True
        return False

    def _insert(self) -> None:
        changed = True
        while changed:
            changed = False
            for state, (cost, last) in list(self.best.items()):
                changed |= self._offer(self.best, AFTER[state], cost + INSERT, last, "I")

    def row(self, initial: str, must_go: bool, broken: bool) -> None:
        best: dict[int, tuple[int, Edit | None]] = {}
        for state, (cost, last) in self.best.items():
            self._offer(best, state, cost + DELETE, last, "D")
            if must_go:
                continue
            stays = cost + BROKEN * broken
            if initial == "s" and state == NOTHING:
                self._offer(best, SYSTEM, stays, last, "K")
            if not initial:
                self._offer(best, state, stays, last, "K")
            if initial == INITIALS[AFTER[state]]:
                self._offer(best, AFTER[state], stays, last, "K")
            else:
                self._offer(best, AFTER[state], stays + REROLE, last, "R")
        self.best = best
        self._insert()
        self._give_up()

    def _give_up(self) -> None:
        """Leave out states that another beats whatever follows.

        All that can follow nothing or a system row can follow an assistant row too; only a system row that is kept first
        would have to be deleted instead.
        """
        cost = self.best[ASSISTANT][0]
        if NOTHING in self.best and cost + DELETE < self.best[NOTHING][0]:
            del self.best[NOTHING]
        if SYSTEM in self.best and cost < self.best[SYSTEM][0]:
            del self.best[SYSTEM]

    def settle(self) -> str:
        """The edits that all states share; they are forgotten here, and the states go on from them."""
        ends = [last for _, last in self.best.values()]
        if any(last is None for last in ends):
            return ""
        n = min(common(ends[0], last) for last in ends) if len(ends) > 1 else ends[0].depth
        if not n:
            return ""
        out = signs(ends[0].at(n))
        made: dict[str, Edit | None] = {"": None}
        for state, (cost, last) in self.best.items():
            rest = signs(last)[n:]
            for i in range(1, len(rest) + 1):
                if rest[:i] not in made:
                    made[rest[:i]] = Edit(made[rest[: i - 1]], rest[i - 1])
            self.best[state] = (cost, made[rest])
        return out

    def end(self) -> tuple[int, str]:
        """Lowest cost and the least audit from what was settled."""
        return min((self.best[state][0], signs(self.best[state][1])) for state in (NOTHING, ASSISTANT) if state in self.best)


class Conversation:
    """One conversation that is streamed row by row: faults, audit and repaired rows."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.repair, self.pending = Repair(), deque()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = self.initial = self.first_turn = self.last_turn = None
        self.turns = self.position = 0
        self.state, self.audit = NOTHING, []
        self.digest, self.any = hashlib.sha256(), False

    def add(self, turn, role: str, text: str, empty: bool, broken: bool, repeated: bool) -> Iterator[tuple]:
        """Take a row; gives the edits that are settled by it."""
        repeated = repeated or self.last == (turn, role, text)
        blank, duplicate = empty, repeated and not empty
        truncated = broken and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.initial + initial not in LEGAL
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.last, self.initial = (turn, role, text), initial
        self.repair.row(initial, blank or duplicate, truncated)
        self.pending.append((role, text))
        if len(self.pending) % WINDOW == 0:
            yield from self._apply(self.repair.settle())

    def _apply(self, audit: str) -> Iterator[tuple]:
        self.audit.append(audit)
        for sign in audit:
            role, text = (None, "") if sign == "I" else self.pending.popleft()
            if sign == "K" and self.state == NOTHING and role[:1] == "s":
                self.state = SYSTEM
            elif sign != "D" and not (sign == "K" and not role):
                self.state = AFTER[self.state]
                role = role if sign == "K" else ROLES[self.state]
            if sign != "D":
                self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
                self.any = True
            yield self.conv_id, self.position, sign, role, text
            self.position += 1

    def end(self) -> Iterator[tuple]:
        self.cost, audit = self.repair.end()
        yield from self._apply(audit)

    def summary(self) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        audit = "".join(self.audit)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, audit, self.digest.hexdigest())


_SUMMARY = "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EDITS = "conv_id {}, position long, edit string, role string, text string"


def _repairer(schema: str, edits: bool):
    names = [field.split()[0] for field in schema.split(", ")]
    texts = {"audit", "repaired_sha256", "edit", "role", "text"}

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, now, kind = [], 0, None, pa.int64()

        def hand_on() -> pa.RecordBatch:
            nonlocal rows, held
            kinds = [kind if n == "conv_id" else pa.string() if n in texts else pa.int64() for n in names]
            out = pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
            rows, held = [], 0
            return out

        def done(conversation: Conversation) -> None:
            nonlocal held
            for edit in conversation.end():
                take(edit)
            if not edits:
                rows.append(conversation.summary())
                held += len(rows[-1][-2]) + 200

        def take(edit: tuple) -> None:
            nonlocal held
            if edits:
                rows.append(edit)
                held += len(edit[-1]) + 100

        for batch in batches:
            kind = batch["conv_id"].type
            columns = [batch[name].to_pylist() for name in ("conv_id", "alive", "turn", "role", "text", "empty", "broken", "repeated")]
            for conv_id, alive, *row in zip(*columns):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done(now)
                    now = Conversation(conv_id)
                if alive:
                    for edit in now.add(*row):
                        take(edit)
                if held >= HELD:
                    yield hand_on()
        if now is not None:
            done(now)
        if rows:
            yield hand_on()

    return repair


def _drawn(conv_id: Column, turn: Column) -> Column:
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    return F.crc32(key.cast("binary")) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, alive, turn, role, text: rows with drawn faults; dropped rows stay with alive = false, so that no conversation is lost."""
    draw = _drawn(F.col("conv_id"), F.col("turn"))
    text = F.coalesce("text", F.lit(" "))
    changed = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, r"[.!?]", "")).when(draw != 0, text).otherwise("")
    rows = conversations.select(
        "conv_id",
        (draw != 0).alias("alive"),
        F.when(draw != 0, F.col("turn")).alias("turn"),
        F.when(draw == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        changed.alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add `repeated`: the same role and text stood in the conversation at an earlier turn.

    Only texts that repeat are joined back, by their digest; rows of the same turn are compared where they are streamed.
    """
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    told = rows.withColumns({"body": F.when(F.col("alive"), F.sha2("text", 256)), "at": at})
    keys = {"conv_id": "k_conv", "role": "k_role", "body": "k_body"}
    per = told.where("alive").groupBy(*[F.col(name).alias(key) for name, key in keys.items()])
    repeats = per.agg(F.min("at").alias("since"), F.max("at").alias("until")).where("since < until").drop("until")
    marked = left_lookup(told, repeats, keys, nulls_match=True)
    return marked.withColumn("repeated", F.coalesce(F.col("since") < F.col("at"), F.lit(False))).drop("body", "at", "since")


def streamed(rows: DataFrame) -> DataFrame:
    """The rows of each conversation in one partition, in their order, with their faults."""
    rest = F.rtrim(F.col("text"), F.lit(WHITE))
    faults = {"empty": rest == "", "broken": ~F.right(rest, F.lit(1)).isin(".", "!", "?")}
    told = _with_repeats(rows).withColumns(faults)
    return told.repartition("conv_id").sortWithinPartitions("conv_id", "alive", "turn", "role", "text")


def _repaired(rows: DataFrame, schema: str, edits: bool) -> DataFrame:
    schema = schema.format(rows.schema["conv_id"].dataType.simpleString())
    return streamed(rows).mapInArrow(_repairer(schema, edits), schema)


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv_id, alive, turn, role, text): its faults, cost, audit and a digest of the repaired text."""
    return _repaired(rows, _SUMMARY, edits=False)


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R, D, I), role, text: all edits of the audits; those that are not D are the repaired conversation."""
    return _repaired(rows, _EDITS, edits=True)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(table(spark, sf_dir, "conversations")))
