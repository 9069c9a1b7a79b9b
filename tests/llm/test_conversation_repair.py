"""Conversation repair against a plain search for the least of the cheapest edits."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest
from test_operators import SMALL, counted

from carryall.llm import conversation_repair as cr

BLANKS = " \t\n\x0b\x0c\r"
SHAPE = "conv_id long, turn long, role string, text string, kind int, copies int, `a.b` string, conv string"
FOLLOWS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.rstrip(BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(turns):
    """(cost, audit, repaired), by keeping the best of every letter reached, row by row."""

    def better(best, state, found):
        if state not in best or found[:2] < best[state][:2]:
            best[state] = found

    def inserted(best):
        for _ in range(2):
            for state, (cost, audit, out) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in FOLLOWS:
                        better(best, letter, (cost + 5, audit + "I", [*out, (role, "")]))
        return best

    best = {"": (0, "", [])}
    for (role, text), fault in zip(turns, faults(turns)):
        best, after = inserted(best), {}
        for state, (cost, audit, out) in best.items():
            better(after, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if (state, role[:1]) in FOLLOWS:
                better(after, role[:1], (cost + more, audit + "K", [*out, (role, text)]))
            for letter, name in (("u", "user"), ("a", "assistant")):
                if (state, letter) in FOLLOWS:
                    better(after, letter, (cost + more + 1, audit + "R", [*out, (name, text)]))
        best = after
    best = inserted(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def report(turns, numbers):
    """The contract's columns for one conversation as it stands."""
    n = collections.Counter(faults(turns))
    known = [t for t in numbers if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r, _ in turns]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    cost, audit, out = cheapest(turns)
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def damaged(rows):
    """Conversations after the damage: their (turn, role, text) in order of turns."""
    out = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        kept = out[conv_id]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda t: (t[0] is not None, t[0] or 0)) for c, r in out.items()}


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = [(c, *report([(r, t) for _, r, t in turns], [n for n, _, _ in turns])) for c, turns in damaged(rows).items()]
    got = cr.repaired_after_damage(df)
    assert got.columns == COLUMNS
    assert counted(got.collect()) == counted(want)


def random_turns(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", " ", "", "User"]
    ends = [".", "!", "?", "", " ", "?\n"]
    out = []
    for k in range(n):
        role = roles[k % 2] if rng.random() < 0.7 else rng.choice(roles)
        text = "" if rng.random() < 0.05 else f"text {rng.randrange(3 * n)}{rng.choice(ends)}"
        out.append(out[-1] if out and rng.random() < 0.1 else (role, text))
    return out


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(cr, "PART_ROWS", 7)


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_given_conversations(spark):
    check(spark.read.parquet(f"{SMALL}/conversations.parquet"))


def test_conversations_over_partitions_and_parts(spark, small_parts, many_partitions):
    """Most conversations are cut by a partition's end, or longer than a part."""
    rng = random.Random(1)
    rows = []
    for c, n in enumerate((1, 2, 3, 60, 5, 120, 1, 90, 4)):
        rows += [(c, k + k // 9, r, t) for k, (r, t) in enumerate(random_turns(rng, n))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check(df)
    # One conversation of all rows: repeats and gaps reach over its chunks.
    check(df.selectExpr("7L conv_id", "conv_id * 1000 + turn turn", "role", "concat('x', length(text), '.') text"))


@pytest.mark.parametrize("passes", [0, 1, 20])
def test_chunks_that_never_converge(spark, small_parts, many_partitions, passes):
    """Texts without an end, and repeated rows: nearly all have to go; passes do not decide."""
    turns = [("system", "start.")] + [("user", f"no end {k}") for k in range(60)] + [("user", "same.")] * 40 + [("assistant", "so."), ("user", "ok")]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    reports, repaired = cr.repair(df, passes=passes)
    got, digest = reports.first(), cr.digests(repaired).first()
    want = report(turns, range(len(turns)))
    assert (*(got[c] for c in COLUMNS[1:8]), digest["repaired_sha256"]) == want
    assert repaired.where("not whole").count() > 8


def test_odd_tables(spark, small_parts):
    rows = [
        (1, 0, "user", "Hello."),
        (1, 1, "assistant", "Hi."),
        (2, None, None, None),
        (2, None, "user", "Without a turn."),
        (2, 5, "assistant", "x" * 200_000),
        (2, 9, "assistant", "x" * 200_000),
        (3, -(2**62), "user", "far."),
        (3, 2**62, "assistant", "apart."),
        (None, 1, "user", "No conversation."),
        (None, 1, "user", "No conversation."),
        (None, None, None, ""),
        (5, 3, "", " \t\x0b "),
        (6, 1, "system", "Only."),
        (7, 1, "sysop", "é日本?\r"),
        (7, 2, "ulysses", "a:b\nc!"),
        (7, 3, "ada", "　."),
    ]
    df = spark.createDataFrame([(*r, 9, 9, "x", "y") for r in rows], SHAPE)
    check(df)
    # Every conversation that has a row is there, also one that lost all of them.
    gone = next(c for c in range(100, 200) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    out = cr.repaired_after_damage(spark.createDataFrame([(gone, 1, "user", "x.")], "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in out.collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.repaired_after_damage(spark.createDataFrame([], SHAPE)).count() == 0


def test_a_third_of_all_rows_is_one_row(spark, small_parts):
    rows = [(1 if k % 3 == 0 else k, 0 if k % 3 == 0 else k, "user", "the same." if k % 3 == 0 else f"text {k}.") for k in range(300)]
    check(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_repaired_turns_are_given(spark):
    df = spark.createDataFrame([(1, 0, "user", "Q?"), (1, 1, "user", "A."), (1, 2, "assistant", "B.")], "conv_id long, turn long, role string, text string")
    reports, turns = cr.repair(df)
    assert reports.first()["audit"] == "DKK"
    assert [(t.role, t.text) for t in turns.first()["turns"]] == [("user", "A."), ("assistant", "B.")]


def test_costs_and_edits():
    rng = random.Random(2)
    for n in [*range(9)] * 30:
        turns = random_turns(rng, n)
        codes = bytes(
            0 if f in ("blank", "duplicate") else 1 + {"s": 1, "u": 2, "a": 3}.get(r[:1], 0) + 4 * (f == "truncated")
            for (r, _), f in zip(turns, faults(turns))
        )
        v = cr.costs(codes, cr.END)
        ops, state = cr.trace(codes, v, 0)
        out, audit, cost = cr.edited(ops, codes, 0, turns, cr.ending(state))
        assert (cost, audit, out) == cheapest(turns) and cost == v[0]
        # Any other end, by lockstep and by matrix, as by a run of its own.
        end = cr.start_costs(bytes(rng.choices(range(9), k=3)), cr.END)
        want = cr.start_costs(codes, end)
        assert cr.fixed_up(codes, cr.END, tuple(v[:4]), end) == want
        m = cr.matrix(codes)
        assert tuple(min(m[p][q] + end[p] for p in range(4)) for q in range(4)) == want
