"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

The rows of a conversation lie together in one partition, in order of their turn. They are read as a
stream, and a small state goes along from row to row and over the borders of Arrow batches: for each
place in the pattern ``(system? (user assistant)+)?`` the cheapest cost of getting there, and which of
those ways has the least edits in ASCII order. How each was reached is kept as four bytes per row; these
backpointers and the texts leave memory for an unnamed file of the task once a conversation is large,
and the way is read off backwards at its end.

Ways are never held as strings. Up to a row each way ends with the edit of that row, so none is the
beginning of another, and their order only depends on the order one row before and on the last step.
Each step depends on little (costs relative to the least, order, kind of row), so steps are remembered
and a row costs a lookup.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pledgemart.llm.common import limit_batches, pick

_BLANKS = " \t\n\x0b\x0c\r"
#: Backpointers and texts of one conversation that stay in memory, in bytes.
HELD = 8 << 20
#: Rows of results that are handed over at a time.
ROWS, BYTES = 2000, 8 << 20
# Places in the pattern: nothing yet, behind the system row, behind a user row, behind an assistant row.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_BEHIND = {_NONE: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_NEVER = 1 << 60
#: Kinds of steps: rows put in before (at most two can be of use), then the row's own edit.
_STEPS = ["I" * n + edit for n in range(3) for edit in "DKR"]
REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "place long, edit string, role string, text string"


@dataclass(frozen=True)
class Costs:
    """What the edits cost; a row that is kept or given another role although its text is cut off costs ``truncated`` more."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class _Steps:
    """One row's step from each way of reaching a place to the next ones."""

    def __init__(self, costs: Costs):
        self.costs, self._known = costs, {}

    def start(self) -> tuple:
        """Costs by place, and the places in ASCII order of their ways."""
        return (0, _NEVER, _NEVER, _NEVER), (_NONE,)

    def step(self, state: tuple, kind: tuple) -> tuple[tuple, int, bytes]:
        """The next state, what its least cost adds, and (place before, step) of each place."""
        key = state, kind
        if (known := self._known.get(key)) is None:
            if len(self._known) > 100_000:
                self._known.clear()
            known = self._known[key] = self._next(*state, *kind)
        return known

    def _next(self, costs: tuple, order: tuple, initial: str, must_go: bool, cut_off: bool) -> tuple:
        best: dict[int, tuple] = {}
        for rank, place in enumerate(order):
            at, paid = place, costs[place]
            for n in range(3):
                for edit, to, cost in self._edits(at, initial, must_go, cut_off):
                    # Of equal costs the earlier way in ASCII order, and behind the same way the lesser step.
                    option = (paid + cost, rank, "I" * n + edit, place)
                    if to not in best or option < best[to]:
                        best[to] = option
                at, paid = _BEHIND[at], paid + self.costs.insert
        least = min(option[0] for option in best.values())
        after = tuple(best[p][0] - least if p in best else _NEVER for p in range(4))
        sorted_places = tuple(sorted(best, key=lambda p: best[p][1:3]))
        back = bytes(best[p][3] << 4 | _STEPS.index(best[p][2]) if p in best else 255 for p in range(4))
        return (after, sorted_places), least, back

    def _edits(self, at: int, initial: str, must_go: bool, cut_off: bool) -> Iterator[tuple[str, int, int]]:
        yield "D", at, self.costs.delete
        if must_go:
            return
        more = self.costs.truncated if cut_off else 0
        if initial == "s" and at == _NONE:
            yield "K", _SYSTEM, more
        if initial == ("a" if _BEHIND[at] == _ASSISTANT else "u"):
            yield "K", _BEHIND[at], more
        yield "R", _BEHIND[at], self.costs.rerole + more

    def finish(self, state: tuple) -> tuple[int, int, int]:
        """Cost, place and number of rows put in at the end, of the best way."""
        costs, order = state
        options = []
        for rank, place in enumerate(order):
            at, n = place, 0
            while at not in (_NONE, _ASSISTANT):
                at, n = _BEHIND[at], n + 1
            options.append((costs[place] + n * self.costs.insert, rank, place, n))
        cost, _, place, n = min(options)
        return cost, place, n


class _Spool:
    """Bytes that are written once; beyond ``HELD`` they go to an unnamed file that ends with the task."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=HELD)

    def write(self, raw: bytes) -> None:
        self.file.write(raw)

    def backwards(self, width: int, size: int) -> Iterator[bytes]:
        """Records of ``width`` bytes from the last to the first, of ``size`` bytes in all."""
        block = width << 16
        end = size
        while end:
            begin = (end - 1) // block * block
            self.file.seek(begin)
            raw = self.file.read(end - begin)
            for at in range(len(raw) - width, -1, -width):
                yield raw[at : at + width]
            end = begin

    def rows(self) -> Iterator[tuple[str, str]]:
        self.file.seek(0)
        while head := self.file.read(8):
            a, b = struct.unpack("<II", head)
            yield self.file.read(a).decode(), self.file.read(b).decode()

    def close(self) -> None:
        self.file.close()


class _Conversation:
    """The rows of one conversation, one after the other."""

    def __init__(self, name, steps: _Steps):
        self.name, self.steps, self.state, self.base = name, steps, steps.start(), 0
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.before = None
        self.back, self.held = _Spool(), _Spool()

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None:
            if turn != self.most:  # turns ascend
                self.turns, self.most = self.turns + 1, turn
                self.least = turn if self.least is None else self.least
        said = text.strip(_BLANKS)
        blank = not said
        duplicate = again and not blank
        cut_off = not (blank or duplicate) and said[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + cut_off
        initial = role[:1]
        if self.n and (self.before, initial) not in (("s", "u"), ("u", "a"), ("a", "u")):
            self.illegal += 1
        self.before, self.n = initial, self.n + 1
        kind = (initial if initial in ("s", "u", "a") else "", blank or duplicate, cut_off)
        self.state, least, back = self.steps.step(self.state, kind)
        self.base += least
        self.back.write(back)
        a, b = role.encode(), text.encode()
        self.held.write(struct.pack("<II", len(a), len(b)) + a + b)

    def _way(self) -> tuple[int, bytes, int]:
        """Cost, the step of every row, and how many rows are put in at the end."""
        cost, place, more = self.steps.finish(self.state)
        way, at = bytearray(self.n), self.n
        for record in self.back.backwards(4, 4 * self.n):
            at -= 1
            way[at], place = record[place] & 15, record[place] >> 4
        return self.base + cost, bytes(way), more

    def repaired(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of each row that stays or is put in."""
        _, way, more = self._way()
        at = _NONE
        for step, (role, text) in zip(way, self.held.rows(), strict=True):
            for edit in _STEPS[step]:
                if edit == "D":
                    continue
                at = _SYSTEM if edit == "K" and at == _NONE and role[:1] == "s" else _BEHIND[at]
                yield edit, role if edit == "K" else _NAMES[at], "" if edit == "I" else text
        for _ in range(more):
            at = _BEHIND[at]
            yield "I", _NAMES[at], ""

    def report(self) -> tuple:
        cost, way, more = self._way()
        audit = "".join(map(_STEPS.__getitem__, way)) + "I" * more
        digest = hashlib.sha256()
        for n, (_, role, text) in enumerate(self.repaired()):
            digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()

    def close(self) -> None:
        self.back.close()
        self.held.close()


def _stream(frames: Iterator[pd.DataFrame], steps: _Steps) -> Iterator[_Conversation]:
    """Each conversation as soon as its last row has been read."""
    now = None
    for frame in frames:
        columns = (frame[c].tolist() for c in ("conv", "named", "turn", "has_turn", "role", "text", "again"))
        for conv, named, turn, has_turn, role, text, again in zip(*columns, strict=True):
            name = conv if named else None
            if now is None or name != now.name:
                if now is not None:
                    yield now
                    now.close()
                now = _Conversation(name, steps)
            now.add(turn if has_turn else None, role, text, again)
    if now is not None:
        yield now
        now.close()


def _sorted(turns: DataFrame, conv: str) -> DataFrame:
    """The rows of each conversation in one partition and in order, with a flag on those said before.

    Only the sort by Spark, which spills, holds a conversation's rows; the window shares its partitioning.
    """
    rows = pick(turns, conv, "turn", "role", "text").toDF("conv", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.repartition("conv")
    said = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("again", F.row_number().over(said) > 1)
    rows = rows.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "again")
    # Without nulls whole numbers stay whole in pandas.
    return rows.select(
        F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("conv"), F.col("conv").isNotNull().alias("named"),
        F.coalesce("turn", F.lit(0).cast("bigint")).alias("turn"), F.col("turn").isNotNull().alias("has_turn"), "role", "text", "again",
    )


def report(turns: DataFrame, costs: Costs = Costs(), conv: str = "conv_id") -> DataFrame:  # noqa: B008
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults and its cheapest repair.

    Columns: conv_id, gaps (turns that are missing between the least and the greatest), blank, duplicate and
    truncated (rows by their first fault), illegal (neighbours whose roles do not follow each other), cost,
    audit (the edits in order: Delete, Insert, Keep, Rerole) and repaired_sha256 (of the repaired
    ``role:text`` lines, joined by newlines; the digest is taken along in the stream, as no row could hold
    every conversation).

    Rows are taken by turn, null turns first, of equal turns by role and text. A null role or text is one
    space; a null conv_id is a conversation; repeated rows are duplicates; texts of any length are read
    whole; an empty table has no conversations; further columns are dropped. A role other than one that begins
    with s, u or a can't be kept. One conversation is read by one task as a stream, whatever its length.
    """
    limit_batches(turns.sparkSession)
    kind = turns.schema[turns.columns.index(conv)].dataType
    steps = _Steps(costs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, out, size = ["conv", *(p.split()[0] for p in REPORT.split(", "))], [], 0
        for c in _stream(frames, steps):
            out.append((c.name, *c.report()))
            size += c.n
            if len(out) >= ROWS or size >= BYTES:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0
        yield pd.DataFrame(out, columns=names)

    found = _sorted(turns, conv).mapInPandas(run, f"conv string, {REPORT}")
    return found.select(F.col("conv").cast(kind).alias(conv), *found.columns[1:])


def repair(turns: DataFrame, costs: Costs = Costs(), conv: str = "conv_id") -> DataFrame:  # noqa: B008
    """The repaired rows themselves: conv_id, place (from 0), edit (K, R or I), role, text; see ``report``."""
    limit_batches(turns.sparkSession)
    kind = turns.schema[turns.columns.index(conv)].dataType
    steps = _Steps(costs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, out, size = ["conv", *(p.split()[0] for p in TURNS.split(", "))], [], 0
        for c in _stream(frames, steps):
            for place, row in enumerate(c.repaired()):
                out.append((c.name, place, *row))
                size += len(row[2])
                if len(out) >= ROWS or size >= BYTES:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
        yield pd.DataFrame(out, columns=names)

    found = _sorted(turns, conv).mapInPandas(run, f"conv string, {TURNS}")
    return found.select(F.col("conv").cast(kind).alias(conv), *found.columns[1:])
