import hashlib
import random
import re
import zlib
from itertools import product

import pandas as pd
import pytest

from pledgemart.llm import conversations, queries

LEGAL = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def brute(rows, costs=conversations.Costs()):
    """Every edit of a short conversation, tried; rows are (turn, role, text) in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        fault = "" if said[-1:] in (".", "!", "?") else "truncated"
        if (role, text) in seen:
            fault = "duplicate"
        if not said:
            fault = "blank"
        seen.add((role, text))
        faults.append(fault)
    initials = [r[1][:1] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    best = None
    inserts = [(), *((x,) for x in "ua"), *product("ua", repeat=2)]
    edits = ["K", "D", "Ru", "Ra"]
    ways = [(0, "", "", ())]
    for i, (_, role, text) in enumerate(rows):
        more = []
        for cost, audit, shape, out in ways:
            for put, edit in product(inserts, edits):
                if faults[i] in ("blank", "duplicate") and edit != "D":
                    continue
                c = cost + costs.insert * len(put)
                new = [*out, *(({"u": "user", "a": "assistant"}[x], "") for x in put)]
                s = shape + "".join(put)
                if edit == "D":
                    c += costs.delete
                else:
                    c += costs.truncated * (faults[i] == "truncated") + costs.rerole * (edit != "K")
                    now = {"K": role, "Ru": "user", "Ra": "assistant"}[edit]
                    new.append((now, text))
                    s += now[:1] or "-"
                # Beginnings of what is legal only, to keep the number of ways small.
                if re.fullmatch(r"s?(ua)*u?", s):
                    more.append((c, audit + "I" * len(put) + edit[0], s, tuple(new)))
        ways = more
    if rows:
        for cost, audit, shape, out in ways:
            for put in inserts:
                if LEGAL.fullmatch(shape + "".join(put)):
                    end = tuple(({"u": "user", "a": "assistant"}[x], "") for x in put)
                    option = (cost + costs.insert * len(put), audit + "I" * len(put), (*out, *end))
                    best = option if best is None else min(best, option)
    cost, audit, out = best or (0, "", ())
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    ), out


def random_conversation(rng, n):
    return [
        (rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", " ", "", "useless"]), rng.choice(["Yes.", "no", " ", "", "Well!\n", "So? ", "é"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("costs", [conversations.Costs(), conversations.Costs(rerole=3, delete=7, insert=1, truncated=2)])
def test_reports_match_brute_force(spark, costs):
    rng = random.Random(4)
    given = {i: random_conversation(rng, rng.choice([1, 2, 3, 4])) for i in range(150)}
    rows = [(i, *row) for i, held in given.items() for row in held]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.report(turns, costs).collect()}
    assert got == {i: brute(held, costs)[0] for i, held in given.items()}
    repaired = {}
    for r in sorted(conversations.repair(turns, costs).collect(), key=lambda r: (r.conv_id, r.place)):
        repaired.setdefault(r.conv_id, []).append((r.role, r.text))
    assert repaired == {i: list(out) for i, held in given.items() if (out := brute(held, costs)[1])}


def damaged(rows):
    """What the query's damage does, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def test_query_on_awkward_conversations(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(60)]), *row) for row in random_conversation(rng, 170)]
    rows = [(c, t, None if r == " " else r, None if x == " " else x) for c, t, r, x in rows]
    rows += [(1000 + i, i, "user", "Yes.") for i in range(40)]  # some of one row, which may be lost
    rows = [r for r in rows if sum(x[0] == r[0] for x in rows) <= 5]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS TEXT", "2 AS conv", "3 AS again")
    left = damaged(rows)
    want = {c: brute([r[1:] for r in left if r[0] == c])[0] for c in {r[0] for r in rows}}
    assert (0, 0, 0, 0, 0, 0, "", EMPTY) in want.values()
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_frame(turns).collect()}
    assert got == want
    assert queries.op11_frame(turns.limit(0)).count() == 0


def test_query_counts_of_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = damaged(rows)
    got = {r.conv_id: r for r in queries.op11(spark, sf_dir).collect()}
    assert got.keys() == {r[0] for r in rows}
    for c, r in got.items():
        own = [x[1:] for x in left if x[0] == c]
        if len(own) <= 4:
            assert tuple(r)[1:] == brute(own)[0]
        assert len(re.sub("I", "", r.audit)) == len(own)


def test_a_giant_conversation_is_streamed(spark, monkeypatch):
    """Backpointers and texts go to a file, and batch borders make no difference."""
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"{i} {rng.choice(['Yes.', 'no', 'é!'])}") for i in range(30000)]
    steps = conversations._Steps(conversations.Costs())

    def run(held, batch):
        monkeypatch.setattr(conversations, "HELD", held)
        frame = pd.DataFrame([("1", True, t, True, r, x, False) for _, t, r, x in rows], columns="conv named turn has_turn role text again".split())
        frames = (frame[i : i + batch] for i in range(0, len(frame), batch))
        return [c.report() for c in conversations._stream(frames, steps)]

    small, whole = run(1000, 777), run(1 << 30, 1 << 20)
    assert small == whole
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert [tuple(r)[1:] for r in conversations.report(turns).collect()] == whole
    shape = "".join({"user": "u", "assistant": "a"}[r.role] for r in sorted(conversations.repair(turns).collect(), key=lambda r: r.place))
    assert LEGAL.fullmatch(shape)


def test_one_shuffle_of_the_rows(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Yes.")], "conv_id long, turn long, role string, text string")
    plan = conversations.report(turns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
