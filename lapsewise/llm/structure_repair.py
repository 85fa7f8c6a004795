r"""Repair of the structure of conversations, as secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn, so a task reads each conversation as a
stream, whatever its length, across Arrow batches. Per row a dynamic program over the four states of
the wanted order of roles, ``(s?(ua)+)?``, keeps the cheapest edits that lead to each state; what it
carries on is the differences of the costs and the order of the edit strings, of which there are few,
so steps are remembered and a row costs a lookup. One small number a row leads back; these numbers
and the row texts of a giant conversation go to temporary files until its last row is known.

Whether a row was seen earlier does not need the rows in memory: the first occurrence of each (role,
text) is found by an aggregate and comes as a marker row just before it in the sort.

Edits: keep 0, rerole to user or assistant 3, delete 4 (all that blank and duplicate rows allow),
insert an empty user or assistant row 3; a truncated row that stays costs 3 more. Among the cheapest
the string of edit initials that is least in ASCII wins; it fixes the roles too.

A null role or text is one space, rows without a conv_id are one conversation, null turns come first,
equal turns follow in the order of role and text hash, repeated rows are duplicates, a conversation
that the damage emptied gives zeros, and an empty table gives nothing.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import shuffle_tasks

#: The white space of the contract: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the order of roles: nothing yet, after the system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Rows whose backpointers, and bytes of role and text, that stay in memory.
POINTERS, SPOOL = 1 << 20, 8 << 20
MARK, ROW, GONE = 0, 1, 2
NONE, BLANK, CUT = 0, 1, 3


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows dropped, emptied, stripped of ``[.!?]``, repeated or
    given to the user, by a hash of their id and turn. A dropped row stays, marked as ``gone``."""

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("copy", copies).select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone"))


def row_stream(rows: DataFrame) -> DataFrame:
    """Rows and markers of first occurrences, by conversation, sorted."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(trimmed == "", BLANK).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), CUT).otherwise(NONE)
    rows = rows.select(
        F.col("conv_id").isNotNull().alias("has_id"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
        "role", "text", F.xxhash64(F.lit(5), "role", "text").alias("hi"), F.xxhash64(F.lit(6), "role", "text").alias("lo"), fault.alias("fault"), "gone",
    )
    firsts = rows.filter(~F.col("gone")).groupBy("has_id", "conv_id", "role", "hi", "lo").agg(F.min(F.struct("has_turn", "turn")).alias("at"))
    marks = firsts.select("has_id", "conv_id", "at.has_turn", "at.turn", "role", F.lit("").alias("text"), "hi", "lo", F.lit(NONE).alias("fault"), F.lit(MARK).alias("kind"))
    kept = rows.select(
        "has_id", "conv_id", "has_turn", "turn", F.when(F.col("gone"), "").otherwise(F.col("role")).alias("role"), F.when(F.col("gone"), "").otherwise(F.col("text")).alias("text"),
        "hi", "lo", "fault", F.when(F.col("gone"), GONE).otherwise(ROW).alias("kind"),
    )
    return kept.unionByName(marks).repartition(shuffle_tasks(rows.sparkSession), "has_id", "conv_id").sortWithinPartitions("has_id", "conv_id", "has_turn", "turn", "role", "hi", "lo", "kind")


def _after_inserts(state: int) -> Iterator[tuple[int, int]]:
    """(number of inserted rows, state): more than two only come back to the same states."""
    yield 0, state
    for number in (1, 2):
        state = ASSISTANT if state == USER else USER
        yield number, state


def _edits(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state) of a row that comes in ``state``; ``fault`` is NONE, CUT, or one that requires deletion."""
    yield "D", DELETE, state
    if fault not in (NONE, CUT):
        return
    more = TRUNCATED if fault == CUT else 0
    if initial == "s" and state == START:
        yield "K", more, SYSTEM
    following = ASSISTANT if state == USER else USER
    if initial == ("a" if state == USER else "u"):
        yield "K", more, following
    yield "R", REROLE + more, following


Carried = tuple[tuple[int, int] | None, ...]


@lru_cache(100_000)
def step(carried: Carried, initial: str, fault: int) -> tuple[Carried, int, tuple]:
    """One row of the dynamic program. ``carried`` has, by state, (cost above the least, place of the
    edit string among those of the other states), or None. Returns the same after the row, what the
    least cost grew by, and by state (state before, inserts, edit).

    Edit strings that end in the edit of the same row are never prefixes of one another, so their
    places decide every comparison of what grows out of them."""
    best: dict[int, tuple] = {}
    for before, held in enumerate(carried):
        if held is None:
            continue
        for inserts, state in _after_inserts(before):
            for edit, cost, after in _edits(state, initial, fault):
                found = (held[0] + INSERT * inserts + cost, held[1], "I" * inserts + edit, before, inserts, edit)
                if after not in best or found < best[after]:
                    best[after] = found
    least = min(x[0] for x in best.values())
    places = {state: place for place, (_, state) in enumerate(sorted((x[1:3], state) for state, x in best.items()))}
    now = tuple((best[s][0] - least, places[s]) if s in best else None for s in range(4))
    return now, least, tuple(best[s][3:] if s in best else None for s in range(4))


#: Inserts at the end that make an order of roles complete.
_CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


class Pointers:
    """A growing list of small numbers, read backwards once; beyond ``limit`` on disk."""

    def __init__(self, limit: int = POINTERS):
        self.limit, self.recent, self.file, self.blocks = limit, array("I"), None, 0

    def append(self, number: int) -> None:
        self.recent.append(number)
        if len(self.recent) >= self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self.recent.tofile(self.file)
            self.recent, self.blocks = array("I"), self.blocks + 1

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.recent)
        for block in reversed(range(self.blocks)):
            self.file.seek(block * self.limit * self.recent.itemsize)
            numbers = array("I")
            numbers.fromfile(self.file, self.limit)
            yield from reversed(numbers)
        if self.file:
            self.file.close()


class Texts:
    """Role and text of the rows of a conversation, read forwards once; beyond ``limit`` bytes on disk."""

    LENGTHS = struct.Struct("<II")

    def __init__(self, limit: int = SPOOL):
        self.limit, self.rows, self.size, self.file = limit, [], 0, None

    def append(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.size += len(text)
        if self.size > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            for pair in self.rows:
                raw = [x.encode("utf-8", "surrogatepass") for x in pair]
                self.file.write(self.LENGTHS.pack(*map(len, raw)) + b"".join(raw))
            self.rows, self.size = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            self.file.seek(0)
            with self.file:
                while raw := self.file.read(self.LENGTHS.size):
                    yield tuple(self.file.read(n).decode("utf-8", "surrogatepass") for n in self.LENGTHS.unpack(raw))
        yield from self.rows


class Conversation:
    """What is carried from row to row of one conversation."""

    def __init__(self, pointers: int = POINTERS, spool: int = SPOOL):
        self.carried: Carried = ((0, 0), None, None, None)
        self.cost = 0
        self.numbers, self.steps = {}, []
        self.pointers, self.texts = Pointers(pointers), Texts(spool)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last_initial = 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int, again: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial = initial
        name = "blank" if fault == BLANK else "duplicate" if again else "truncated" if fault == CUT else None
        if name:
            self.faults[name] += 1
        wanted = NONE if name is None else CUT if name == "truncated" else BLANK
        self.carried, grown, back = step(self.carried, initial if initial in ("s", "u", "a") else "", wanted)
        self.cost += grown
        number = self.numbers.setdefault(back, len(self.steps))
        if number == len(self.steps):
            self.steps.append(back)
        self.pointers.append(number)
        self.texts.append(role, text)

    def gaps(self) -> int:
        return 0 if self.turns == 0 else min(self.last_turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)

    def repaired(self) -> tuple[int, str, Iterator[tuple[str, str]]]:
        """The cost, the audit and the rows that remain."""
        extra, _, state = min((held[0] + INSERT * _CLOSING[s], held[1], s) for s, held in enumerate(self.carried) if held)
        closing = _CLOSING[state]
        letters = ["I" * closing]
        for number in self.pointers.backwards():
            state, inserts, edit = self.steps[number][state]
            letters.append("I" * inserts + edit)
        audit = "".join(reversed(letters))
        return self.cost + extra, audit, self._rows(audit)

    def _rows(self, audit: str) -> Iterator[tuple[str, str]]:
        state, rows = START, iter(self.texts)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit == "D":
                continue
            if edit == "K" and role.startswith("s"):
                state = SYSTEM
            else:
                state = ASSISTANT if state == USER else USER
            yield role if edit == "K" else ROLE[state], text


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, role string, text string"


def _summary(conv_id: int | None, conversation: Conversation) -> list[tuple]:
    cost, audit, rows = conversation.repaired()
    digest, between = hashlib.sha256(), b""
    for role, text in rows:
        digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        between = b"\n"
    return [(conv_id, conversation.gaps(), *conversation.faults.values(), conversation.illegal, cost, audit, digest.hexdigest())]


def _turns(conv_id: int | None, conversation: Conversation) -> Iterator[tuple]:
    _, _, rows = conversation.repaired()
    for place, (role, text) in enumerate(rows):
        yield conv_id, place, role, text


def _streamed(rows: DataFrame, schema: str, results, pointers: int, spool: int) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {field.split()[0]: "Int64" for field in schema.split(", ") if field.endswith("long")}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, conversation, mark, out, size = None, None, None, [], 0

        def frame() -> pd.DataFrame:
            return pd.DataFrame(out, columns=names).astype(kinds)

        def ended() -> Iterator[tuple]:
            if key is not None:
                yield from results(key[1] if key[0] else None, conversation)

        def pending() -> Iterator[tuple]:
            nonlocal key, conversation, mark
            for batch in frames:
                columns = [batch[c].tolist() for c in ("has_id", "conv_id", "has_turn", "turn", "role", "text", "hi", "lo", "fault", "kind")]
                for has_id, conv_id, has_turn, turn, role, text, hi, lo, fault, kind in zip(*columns):
                    if key != (has_id, conv_id):
                        yield from ended()
                        key, conversation, mark = (has_id, conv_id), Conversation(pointers, spool), None
                    if kind == MARK:
                        mark = (has_turn, turn, role, hi, lo)
                    elif kind == ROW:
                        first = mark == (has_turn, turn, role, hi, lo)
                        mark = None if first else mark
                        conversation.add(turn if has_turn else None, role, text, fault, not first)
            yield from ended()

        for row in pending():
            out.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(out) >= 5000 or size > SPOOL:
                yield frame()
                out, size = [], 0
        if out:
            yield frame()

    return row_stream(rows).mapInPandas(run, schema)


def summaries(rows: DataFrame, pointers: int = POINTERS, spool: int = SPOOL) -> DataFrame:
    """One row a conversation of ``rows`` (see ``damaged``): its faults, the cheapest edits, the digest of the repaired rows."""
    return _streamed(rows, SUMMARY, _summary, pointers, spool)


def repaired_turns(rows: DataFrame, pointers: int = POINTERS, spool: int = SPOOL) -> DataFrame:
    """The repaired conversations themselves: (conv_id, place, role, text)."""
    return _streamed(rows, TURNS, _turns, pointers, spool)
