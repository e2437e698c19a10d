"""Repair of a conversation's structure by the cheapest edits.

Turns must read ``(s?(ua)+)?`` by the initials of their roles. Deductions over repair items find the edits: an item says that so
many turns are dealt with and which role came last. Each edit of a turn is an axiom with a weight, and a deduction joins an item
with an axiom. Weights are pairs (cost, audit), compared in that order; an edit adds to the cost and to the end of the audit, so
a conclusion never weighs less than its premises. The agenda gives items out lightest first, which makes the first weight that
an item is given out with its least one.

A conversation is read as a stream, a piece of turns at a time. Between pieces live at most four items, one per last role, each
with the digest of its repaired text so far. Memory does not grow with the texts of a conversation, only with its audit.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

# What edits cost, as audit letters; a truncated turn that stays costs more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Characters that count as blank, and how a whole sentence ends.
BLANKS, ENDS = " \t\n\x0b\x0c\r", [".", "!", "?"]
#: Pairs of initials that may follow each other.
LEGAL = frozenset(["su", "ua", "au"])

#: The last role of a repaired beginning: none yet, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
COMPLETE = (NONE, ASSISTANT)

#: Turns of a piece. Any number gives the same edits.
PIECE = 64

#: An item between pieces: last role, cost, and a text that sorts like its audit so far.
Entry = tuple[int, int, str]


def kept_as(initial: str, last: int) -> int | None:
    """The last role after a turn that is kept, or None if it may not stand there."""
    if initial == "s":
        return SYSTEM if last == NONE else None
    return NEXT[last] if initial == ("u" if NEXT[last] == USER else "a") else None


def axioms(turn: str, last: int) -> Iterator[tuple[int, str, int]]:
    """Edits of a turn after ``last``: cost, letter, last role. ``turn`` is the initial and its fault: x must go, t is cut off."""
    initial, fault = turn
    yield DELETE, "D", last
    if fault != "x":
        more = TRUNCATED if fault == "t" else 0
        stays = kept_as(initial, last)
        if stays is not None:
            yield KEEP + more, "K", stays
        yield REROLE + more, "R", NEXT[last]


@lru_cache(maxsize=20_000)
def lightest(entries: tuple[Entry, ...], turns: tuple[str, ...], to_goal: bool) -> dict[int, tuple[int, str, int]]:
    """The least weights after ``turns``: for each last role (cost, audit with the entry's text before it, entry's role).

    With ``to_goal`` the first complete conversation ends the search and is the only one returned.
    """
    agenda = [(cost, text, 0, last, last) for last, cost, text in entries]
    heapq.heapify(agenda)
    done: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str, int]] = {}
    while agenda:
        cost, audit, at, last, entry = heapq.heappop(agenda)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(turns):
            if not to_goal:
                found[last] = (cost, audit, entry)
            elif last in COMPLETE:
                return {last: (cost, audit, entry)}
        else:
            for more, letter, role in axioms(turns[at], last):
                if (at + 1, role) not in done:
                    heapq.heappush(agenda, (cost + more, audit + letter, at + 1, role, entry))
        if (at, NEXT[last]) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, NEXT[last], entry))
    return found


def rendered(letters: str, last: int, turns: list[tuple[str, Any]]) -> Iterator[tuple[str, Any, str]]:
    """Role, turn (None if inserted) and letter of every repaired turn that ``letters`` leave after ``last``."""
    at = 0
    for letter in letters:
        if letter != "D":
            turn = None if letter == "I" else turns[at]
            last = kept_as(turn[0][:1], last) if letter == "K" else NEXT[last]
            yield (turn[0] if letter == "K" else NAMES[last]), turn, letter
        at += letter != "I"


@dataclass
class Conversation:
    """One conversation's turns, read in order."""

    #: Items between pieces: by last role the cost, the sorting text, the audit as a chain of segments, and the digest.
    items: dict = field(default_factory=lambda: {NONE: (0, "", None, hashlib.sha256())})
    piece: list = field(default_factory=list)
    numbers: dict = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0))
    before: str | None = None
    first: int | None = None
    latest: int | None = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if fault:
            self.numbers[fault] += 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.numbers["illegal"] += 1
        self.before = initial
        if turn is not None:
            self.numbers["distinct"] += turn != self.latest
            self.first, self.latest = turn if self.first is None else self.first, turn
        must = {"": "-", "truncated": "t"}.get(fault, "x")
        self.piece.append((role, text, (initial if initial in ("s", "u", "a") else "?") + must))
        if len(self.piece) == PIECE:
            self.advance(to_goal=False)

    def advance(self, to_goal: bool) -> None:
        """Deal with the turns of the piece."""
        least = min(item[0] for item in self.items.values())
        entries = tuple((last, item[0] - least, item[1]) for last, item in sorted(self.items.items()))
        found = lightest(entries, tuple(code for _, _, code in self.piece), to_goal)
        # Audits of items at the same turn differ before any insertions at their ends, or in these only: their order is
        # kept by a number for what stands before, and the insertions.
        bases = sorted({audit.rstrip("I") for _, audit, _ in found.values()})
        items = {}
        for last, (cost, audit, entry) in found.items():
            _, text, chain, digest = self.items[entry]
            letters, digest, begun = audit[len(text) :], digest.copy(), entry != NONE
            for role, turn, _ in rendered(letters, entry, self.piece):
                digest.update(f"{'\n' if begun else ''}{role}:{turn[1] if turn else ''}".encode())
                begun = True
            base = audit.rstrip("I")
            items[last] = (cost + least, chr(bases.index(base)) + audit[len(base) :], (chain, letters), digest)
        self.items, self.piece = items, []

    def report(self) -> dict[str, Any]:
        self.advance(to_goal=True)
        ((cost, _, chain, digest),) = self.items.values()
        letters = []
        while chain:
            chain, segment = chain
            letters.append(segment)
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.numbers["distinct"]
        counts = {k: v for k, v in self.numbers.items() if k != "distinct"}
        return {"gaps": gaps, **counts, "cost": cost, "audit": "".join(reversed(letters)), "repaired_sha256": digest.hexdigest()}


REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def first_fault(text: Column, repeated: Column) -> Column:
    """The fault of a turn that counts: blank, duplicate, truncated, or none (empty)."""
    ending = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(blank, "blank").when(repeated, "duplicate").when(~ending.isin(ENDS), "truncated").otherwise("")


def ordered(turns: DataFrame, conversation: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """``key``, ``turn``, ``role``, ``text``, ``here``, ``fault``: conversations whole and in order within partitions; one shuffle."""
    rows = turns.select(
        F.col(conversation).cast("string").alias("key"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))).alias("here"),
    )
    # rows that are not here come last, so that they make no turn a duplicate
    same = Window.partitionBy("key", "role", "text").orderBy(F.col("here").desc(), "turn")
    seen = rows.repartition("key").withColumn("repeated", F.row_number().over(same) > 1)
    placed = seen.sortWithinPartitions("key", "turn", "role", "text", "repeated")
    return placed.select("key", "turn", "role", "text", "here", first_fault(F.col("text"), F.col("repeated")).alias("fault"))


def repair_report(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None
) -> DataFrame:
    """A row per conversation: its faults, the cost and audit of its cheapest repair, and the repaired text's SHA-256.

    Turns are taken by number, nulls first; those of one number by role, then text. A null role or text is one blank. Only a
    turn's first fault counts: blank, duplicate (role and text came earlier), truncated (does not end a sentence). Null
    conversations form one. Rows where ``present`` is not true only name their conversation; one without any turn has zeros, no
    audit and the digest of nothing. An empty table gives no rows; other columns are not looked at.

    Edits: K keeps a turn, R makes it the user's or the assistant's, D deletes it (as blank and repeated ones must be), I inserts an
    empty one. Of equally cheap repairs the one with the least audit counts. ``gaps`` counts the numbers missing between the first and
    the last.

    Turns are shuffled once, by conversation, and sorted, both on disk where they do not fit. A conversation is one text with one
    digest, so one task reads it in order, however long it is, without holding more than a piece of its texts.
    """

    def run(batches) -> Iterator:
        import pandas as pd

        current: Conversation | None = None
        key = None
        for batch in batches:
            out = []
            # numbers as Python's own: pandas makes them floats where some are null
            numbers = [None if n is None or n != n else int(n) for n in batch["turn"].astype(object)]
            for k, n, r, t, here, fault in zip(batch["key"], numbers, batch["role"], batch["text"], batch["here"], batch["fault"]):
                if current is None or k != key:
                    if current is not None:
                        out.append({"key": key, **current.report()})
                    current, key = Conversation(), k
                if here:
                    current.add(n, r, t, fault)
            if out:
                yield pd.DataFrame(out)
        if current is not None:
            yield pd.DataFrame([{"key": key, **current.report()}])

    # turns beyond the exact range of a double would lose digits in pandas: they travel as decimals
    rows = ordered(turns, conversation, turn, role, text, present).withColumn("turn", F.col("turn").cast("decimal(20,0)"))
    found = rows.mapInPandas(run, f"key string, {REPORT}")
    kind = turns.schema[conversation].dataType
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", conversation)


def repaired_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: ``conversation``, ``place`` (from 0), ``turn``, ``role``, ``text``, ``edit``, a row per turn that stands.

    Inserted turns have no number and empty text. Cases as in ``repair_report``, whose audits meet the turns in one sorted stream:
    a task holds one audit and a batch of turns.
    """
    rows = ordered(turns, conversation, turn, role, text, None).select("key", "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    audits = repair_report(turns, conversation, turn, role, text).select(
        F.col(conversation).cast("string").alias("key"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("turn", "bigint"), ("role", "string"), ("text", "string"))],
        "audit",
    )
    # an audit comes before the turns of its conversation
    both = rows.unionByName(audits).repartition("key").sortWithinPartitions("key", F.col("audit").isNull(), "turn", "role", "text")

    def run(batches) -> Iterator:
        import pandas as pd

        key, letters, at, place, last = None, "", 0, 0, NONE
        for batch in batches:
            out = []

            def inserted() -> None:
                nonlocal at, place, last
                while at < len(letters) and letters[at] == "I":
                    last, at = NEXT[last], at + 1
                    out.append((key, place, None, NAMES[last], "", "I"))
                    place += 1

            for k, n, r, t, audit in zip(batch["key"], batch["turn"].astype(object), batch["role"], batch["text"], batch["audit"]):
                if audit is not None:
                    key, letters, at, place, last = k, audit, 0, 0, NONE
                    inserted()
                    continue
                letter, at = letters[at], at + 1
                if letter != "D":
                    last = kept_as(r[:1], last) if letter == "K" else NEXT[last]
                    out.append((key, place, None if n is None or n != n else int(n), r if letter == "K" else NAMES[last], t, letter))
                    place += 1
                inserted()
            yield pd.DataFrame(out, columns=["key", "place", "turn", "role", "text", "edit"]).astype({"turn": object})

    both = both.withColumn("turn", F.col("turn").cast("decimal(20,0)"))
    found = both.mapInPandas(run, "key string, place bigint, turn bigint, role string, text string, edit string")
    return found.withColumn("key", F.col("key").cast(turns.schema[conversation].dataType)).withColumnRenamed("key", conversation)
