"""Repair of conversations by A* on the lattice of edits.

A repaired conversation is empty, or an optional system turn and then user and assistant turns by turns, an assistant's
last. Turns are kept (0), given another role (2), deleted (3), or inserted with an empty text (2); a blank turn and one
that repeats an earlier one must go, and a truncated turn that stays costs 1 more. The cheapest repair is found over the
states (turns read, what may follow); its heuristic is the sum, over the turns ahead, of what each costs at least: 3 if it
must go, 1 if it is truncated. The queue is ordered by (cost plus heuristic, edits so far), so of equally cheap repairs
the one whose edits' initials come first in ASCII is reached first.

Conversations are read turn by turn. After ``WINDOW`` turns the search stops at each state of the window's end; a state
that costs over ``SLACK`` more than the cheapest can't win any more (any state can do what another does next for 5 more:
insert a turn, and delete a system turn or complete a pair), and edits that all remaining states share are final. So a long
conversation takes the memory of the turns that are still open, not of all.

Defined results: a null role or text counts as one space; turns of equal number follow each other by role and text, null
numbers come first; a null conv_id is a conversation of its own; repeated rows are duplicates of each other; texts of any
length are kept whole; an empty role can't stay and has no legal neighbour; a conversation without turns has no row; an
empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import os.path
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen, joined_small, materialize

WINDOW = 512
SLACK = 5
#: Conversations of up to so many turns are remembered by what their turns are like.
REMEMBERED_TURNS = 64
DELETE, INSERT, REROLE = 3, 2, 2
#: What a turn is like beside its role's initial.
WHOLE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: States: nothing yet, after a system turn, after a user's, after an assistant's.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_COMPLETE = (EMPTY, ASSISTANT)
_WANTED = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_KEEP = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_LEGAL = {"su", "ua", "au"}
_ASCII_SPACE = " \t\n\x0b\x0c\r"


class Turn(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: int


class Edit(NamedTuple):
    """One edit of a repair: K(eep), R(erole), D(elete) or I(nsert), and the turn as it is then."""

    op: str
    turn: int | None
    role: str
    text: str


def search(likes: tuple[tuple[str, int], ...], begin: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """By state, the least (cost, edits) with which all turns are read, from states with costs and edits of their own.

    Where these are the last turns, only the best complete state is given.
    """
    n = len(likes)
    ahead = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        ahead[k] = ahead[k + 1] + (0, 1, DELETE, DELETE)[likes[k][1]]
    queue = [(cost + ahead[0], edits, 0, state) for state, (cost, edits) in begin.items()]
    heapq.heapify(queue)
    done: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while queue:
        bound, edits, k, state = heapq.heappop(queue)
        if (k, state) in done:
            continue
        done.add((k, state))
        cost = bound - ahead[k]
        if k == n:
            if last and state in _COMPLETE:
                return {state: (cost, edits)}
            found[state] = (cost, edits)
            if len(found) == len(_WANTED):
                break
        following = _WANTED[state][1]
        heapq.heappush(queue, (bound + INSERT, edits + "I", k, following))
        if k < n:
            initial, fault = likes[k]
            rest = cost + ahead[k + 1]
            heapq.heappush(queue, (rest + DELETE, edits + "D", k + 1, state))
            if fault in (WHOLE, TRUNCATED):
                rest += fault == TRUNCATED
                heapq.heappush(queue, (rest + REROLE, edits + "R", k + 1, following))
                if initial in _KEEP[state]:
                    heapq.heappush(queue, (rest, edits + "K", k + 1, _KEEP[state][initial]))
    return found


@lru_cache(maxsize=100_000)
def _whole(likes: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    return next(iter(search(likes, {EMPTY: (0, "")}, last=True).values()))


@dataclass
class Report:
    """What was wrong with a conversation's turns, and the cheapest repair's cost and edits."""

    conv_id: int | None
    gaps: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    audit: str = ""


@dataclass
class Repair:
    """The repair of one conversation whose turns come in order."""

    conv_id: int | None
    open_: list[Turn] = field(default_factory=list)  # turns whose edits are not final
    read: int = 0  # of these, turns that the states below have read
    states: dict[int, tuple[int, str]] = field(default_factory=lambda: {EMPTY: (0, "")})
    at: int = EMPTY  # the state after the final edits
    audit: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.report = Report(self.conv_id)
        self.before: Turn | None = None
        self.lowest: int | None = None
        self.numbers = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool, blank: bool, truncated: bool) -> Iterator[Edit]:
        """Read a turn; edits that are final since."""
        last, report = self.before, self.report
        again = seen or last is not None and last[:3] == (turn, role, text)
        fault = BLANK if blank else DUPLICATE if again else TRUNCATED if truncated else WHOLE
        report.blank += fault == BLANK
        report.duplicate += fault == DUPLICATE
        report.truncated += fault == TRUNCATED
        report.illegal += last is not None and last.role[:1] + role[:1] not in _LEGAL
        if turn is not None:
            self.lowest = turn if self.lowest is None else self.lowest
            self.numbers += last is None or last.turn != turn
            report.gaps = turn - self.lowest + 1 - self.numbers
        self.before = Turn(turn, role, text, fault)
        self.open_.append(self.before)
        if len(self.open_) - self.read >= WINDOW:
            yield from self._settle()

    def _ahead(self) -> tuple[tuple[str, int], ...]:
        return tuple((t.role[:1], t.fault) for t in self.open_[self.read :])

    def _settle(self) -> Iterator[Edit]:
        found = search(self._ahead(), self.states, last=False)
        self.read = len(self.open_)
        least = min(cost for cost, _ in found.values())
        found = {s: x for s, x in found.items() if x[0] <= least + SLACK}
        shared = os.path.commonprefix([edits for _, edits in found.values()])
        yield from self._final(shared)
        self.states = {s: (cost, edits[len(shared) :]) for s, (cost, edits) in found.items()}

    def _final(self, edits: str) -> Iterator[Edit]:
        self.audit.append(edits)
        k = 0
        for op in edits:
            t = None if op == "I" else self.open_[k]
            k += op != "I"
            role, following = _WANTED[self.at]
            if op == "D":
                yield Edit(op, t.turn, t.role, t.text)
                continue
            if op == "K":
                role, following = t.role, _KEEP[self.at][t.role[:1]]
            yield Edit(op, None if t is None else t.turn, role, "" if t is None else t.text)
            self.at = following
        del self.open_[:k]
        self.read -= k

    def finish(self) -> Iterator[Edit]:
        """The edits that were still open; the report is complete after them."""
        if not self.audit and len(self.open_) <= REMEMBERED_TURNS:
            cost, edits = _whole(self._ahead())
        else:
            cost, edits = next(iter(search(self._ahead(), self.states, last=True).values()))
        self.read = len(self.open_)
        yield from self._final(edits)
        self.report.cost, self.report.audit = cost, "".join(self.audit)


def judged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, and whether an earlier turn says the same (seen), it is blank, or truncated.

    What is said earlier is found by a digest, summed before it is shuffled; only digests that come under several turn
    numbers meet the turns again. Of rows that are equal in all columns the reader takes the first, as they are neighbours.
    """
    said = chosen(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    said = said.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    keys = said.groupBy("conv_id", "digest").agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"))
    again = materialize(keys.filter("first < last or (unnumbered and first is not null)"), "said-again")
    again = again.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.when(~F.col("unnumbered"), F.col("first")).alias("first"))
    met = joined_small(said, again, said["conv_id"].eqNullSafe(again["c"]) & (said["digest"] == again["d"]))
    seen = F.col("d").isNotNull() & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first")))
    end = F.right(F.rtrim(F.col("text"), F.lit(_ASCII_SPACE)), F.lit(1))
    return met.select("conv_id", "turn", "role", "text", seen.alias("seen"), (end == "").alias("blank"), _cut(end).alias("truncated"))


def _cut(end: Column) -> Column:
    return ~end.isin("", ".", "!", "?")


def in_order(turns: DataFrame) -> DataFrame:
    """Judged turns, those of a conversation in one partition and in order."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return judged(turns).repartition("conv_id").sortWithinPartitions(*order)


def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Edit | Report]]:
    """Edits of each conversation of ordered turns as they become final, and its report after them."""
    now: Repair | None = None
    for batch in batches:
        for conv_id, *turn in zip(*[c.to_pylist() for c in batch.columns]):
            if now is None or conv_id != now.conv_id:
                yield from _finished(now)
                now = Repair(conv_id)
            for edit in now.add(*turn):
                yield conv_id, edit
    yield from _finished(now)


def _finished(now: Repair | None) -> Iterator[tuple[int | None, Edit | Report]]:
    if now is not None:
        for edit in now.finish():
            yield now.conv_id, edit
        yield now.conv_id, now.report


EDITS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("op", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def repair_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, place, op, turn, role, text: every edit of every conversation in order; without the rows of op D, the repaired turns."""
    from .common import batches as blocks

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            place = 0
            for conv_id, x in repairs(source):
                if isinstance(x, Report):
                    place = 0
                else:
                    yield {"conv_id": conv_id, "place": place, **x._asdict()}
                    place += 1

        yield from blocks(EDITS, rows(), 1024)

    return in_order(turns).mapInArrow(run, "conv_id long, place long, op string, turn long, role string, text string")
