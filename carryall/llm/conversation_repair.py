"""Conversations brought to the form (s?(ua)+)? by the cheapest edits, as parallel Viterbi.

Rows are range-sorted by conversation and turn, so a conversation, however long, lies in
as many partitions as it needs. What a partition has of one is a chunk. A conversation
that is one chunk is repaired where it is read. Others go on in rounds:

* Costs run backward from each chunk's end. At first every chunk takes the end of a
  conversation for its own (a speculative vector, one cost a state).
* Fix-up passes hand each chunk the vector its successor came to. Old and new vectors run
  in lockstep until they differ only by a constant; from there on nothing changes but
  that constant. Passes go on until no chunk's vector changes.
* Chunks that never forget (all rows have to go) would take a pass a chunk. What is left
  after a few passes is stitched by the chunks' 4 x 4 cost matrices, a row a chunk.
* Edits are traced forward through the stitched costs, the least letter first.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from carryall.sources.tables import pin

# What counts as blank, what ends a turn, the costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
RENAME, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5

# States: nothing yet, after s, after u, after a. Each takes one letter but for s.
_NEXT = (2, 2, 3, 2)
_LETTER = ("user", "user", "assistant", "user")
#: What is still to pay at the end of a conversation, by state.
END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 60
_INITIALS = {"s": 1, "u": 2, "a": 3}
_FINE = {"su", "ua", "au"}
# Codes of rows: 0 has to be deleted; else 1 + initial (other, s, u, a), 4 more if unfinished.
_OPS = "DKR"

# Rows and bytes of a part of a long conversation; bytes up to which one is kept in memory.
PART_ROWS = 4096
PART_BYTES = 4 << 20
# Fix-up passes before matrices take over.
PASSES = 6


# ---------------------------------------------------------------- costs


def back(code: int, v: tuple) -> tuple:
    """Costs before a row from the costs after it, by state; inserts before it included."""
    v0, v1, v2, v3 = v
    if not code:
        return v0 + DELETE, v1 + DELETE, v2 + DELETE, v3 + DELETE
    keep = UNFINISHED if code > 4 else 0
    initial = (code - 1) & 3
    to_u, to_a = RENAME + keep + v2, RENAME + keep + v3
    if initial == 2:
        to_u = keep + v2
    elif initial == 3:
        to_a = keep + v3
    w0, w1, w2, w3 = min(DELETE + v0, to_u), min(DELETE + v1, to_u), min(DELETE + v2, to_a), min(DELETE + v3, to_u)
    if initial == 1:
        w0 = min(w0, keep + v1)
    n2 = min(w2, INSERT + w3)
    return min(w0, INSERT + n2), min(w1, INSERT + n2), n2, min(w3, INSERT + w2)


def level(v) -> tuple:
    """A vector less its smallest cost: equal for vectors that differ by a constant."""
    least = min(v)
    return tuple(x - least for x in v)


def costs(codes: bytes, end: tuple) -> array:
    """The vectors before every row and after the last, four numbers each."""
    out = array("q", bytes(32 * (len(codes) + 1)))
    n = 4 * len(codes)
    v = tuple(end)
    out[n:] = array("q", v)
    for code in reversed(codes):
        v = back(code, v)
        n -= 4
        out[n : n + 4] = array("q", v)
    return out


def start_costs(codes: bytes, end) -> tuple:
    v = tuple(end)
    for code in reversed(codes):
        v = back(code, v)
    return v


def fixed_up(codes: bytes, old_end, old_start, end) -> tuple:
    """The vector before the first row for another end: old and new run in lockstep
    until they differ only by a constant, which then holds for the rest."""
    old, v = tuple(old_end), tuple(end)
    for code in reversed(codes):
        if level(old) == level(v):
            break
        old, v = back(code, old), back(code, v)
    else:
        return v
    return tuple(x + v[0] - old[0] for x in old_start)


def matrix(codes: bytes) -> list[tuple]:
    """For each state after the last row, the costs by state before the first."""
    return [start_costs(codes, tuple(0 if p == q else _FAR for p in range(4))) for q in range(4)]


def trace(codes: bytes, v: array, state: int) -> tuple[bytearray, int]:
    """The least of the cheapest edits from a state on, an op a row, and the state after.

    An op is three times the inserts before the row, plus 0 (delete), 1 (keep), 2 (rename).
    """
    ops, at = bytearray(), 0
    for code in codes:
        inserts = 0
        while True:
            cost = v[at + state]
            if DELETE + v[at + 4 + state] == cost:
                op = 0
            elif INSERT + v[at + _NEXT[state]] == cost:
                inserts += 1
                state = _NEXT[state]
                continue
            else:
                after = _kept(code, state)
                keep = UNFINISHED if code > 4 else 0
                if after and keep + v[at + 4 + after] == cost:
                    op, state = 1, after
                else:
                    op, state = 2, _NEXT[state]
            break
        ops.append(3 * inserts + op)
        at += 4
    return ops, state


def _kept(code: int, state: int) -> int:
    """The state after a kept row; 0 if it cannot be kept there."""
    initial = (code - 1) & 3 if code else 0
    if initial == 1:
        return 1 if state == 0 else 0
    return _NEXT[state] if initial and initial == _NEXT[state] else 0


def ending(state: int) -> int:
    """Inserts after the last row."""
    return {0: 0, 1: 2, 2: 1, 3: 0}[state]


def edited(ops: bytes, codes: bytes, state: int, turns: list[tuple[str, str]], tail: int = 0):
    """(repaired turns, audit, cost) of rows under their ops, from a state on."""
    out, audit, cost = [], [], 0
    for op, code, (role, text) in zip(ops, codes, turns):
        inserts, op = divmod(op, 3)
        for _ in range(inserts):
            out.append((_LETTER[state], ""))
            state = _NEXT[state]
        audit.append("I" * inserts + _OPS[op])
        cost += INSERT * inserts
        if op == 0:
            cost += DELETE
            continue
        cost += (op == 2) * RENAME + (UNFINISHED if code > 4 else 0)
        out.append((_LETTER[state] if op == 2 else role, text))
        state = _NEXT[state] if op == 2 else _kept(code, state)
    for _ in range(tail):
        out.append((_LETTER[state], ""))
        state = _NEXT[state]
    audit.append("I" * tail)
    return out, "".join(audit), cost + INSERT * tail


# ---------------------------------------------------------------- chunks


class _Chunk:
    """What a partition has of one conversation, as it comes in."""

    def __init__(self, conv_id, is_open: bool) -> None:
        self.conv_id, self.is_open = conv_id, is_open
        self.codes, self.digests, self.seen = bytearray(), [], set()
        self.first, self.last, self.n = None, None, 0
        self.blank = self.duplicate = self.illegal = self.distinct = 0
        self.low = self.high = None
        self.turns: list[tuple[str, str]] = []
        self.bytes, self.sent = 0, 0

    def add(self, turn, role: str, text: str) -> None:
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in _FINE
        else:
            self.first = initial
        self.last = initial
        self.n += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        code = 0
        body = text.rstrip(BLANKS)
        if not body:
            self.blank += 1
        else:
            said = f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
            digest = hashlib.blake2b(said, digest_size=16).digest()
            if digest in self.seen:
                self.duplicate += 1
            else:
                self.seen.add(digest)
                self.digests.append(digest)
                code = 1 + _INITIALS.get(initial, 0) + 4 * (body[-1] not in STOPS)
        self.codes.append(code)
        self.turns.append((role, text))
        self.bytes += len(role) + len(text)

    def facts(self) -> dict:
        return {
            "conv_id": self.conv_id, "conv": "" if self.conv_id is None else str(self.conv_id),
            "blank": self.blank, "duplicate": self.duplicate, "truncated": sum(c > 4 for c in self.codes),
            "illegal": self.illegal,
        }

    def whole(self) -> dict:
        codes = bytes(self.codes)
        ops, state = trace(codes, costs(codes, END), 0)
        turns, audit, cost = edited(ops, codes, 0, self.turns, ending(state))
        return self.facts() | {
            "kind": 0, "gaps": _gaps(self.low, self.high, self.distinct), "cost": cost, "audit": audit, "turns": turns,
        }

    def part(self, chunk: int) -> dict:
        """The rows since the last part."""
        row = {"kind": 2, "conv_id": self.conv_id, "conv": self.facts()["conv"], "chunk": chunk, "at": self.sent, "turns": self.turns}
        self.sent += len(self.turns)
        self.turns, self.bytes = [], 0
        return row

    def summary(self, chunk: int, cuts: list[int]) -> dict:
        return self.facts() | {
            "kind": 1, "chunk": chunk, "codes": bytes(self.codes), "digests": self.digests, "cuts": cuts,
            "first": self.first, "last": self.last, "low": self.low, "high": self.high, "distinct": self.distinct,
        }


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SHAPE = {
    "kind": pa.int32(), "conv_id": pa.int64(), "conv": pa.string(), "chunk": pa.int64(), "at": pa.int64(),
    "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(),
    "cost": pa.int64(), "audit": pa.string(), "turns": _TURNS, "codes": pa.binary(), "digests": pa.list_(pa.binary()),
    "cuts": pa.list_(pa.int64()), "first": pa.string(), "last": pa.string(), "low": pa.int64(), "high": pa.int64(),
    "distinct": pa.int64(),
}
_SCHEMA = (
    "kind int, conv_id long, conv string, chunk long, at long, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string, turns array<struct<role: string, text: string>>, codes binary, "
    "digests array<binary>, cuts array<long>, first string, last string, low long, high long, distinct long"
)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if kind != _TURNS:
        return pa.array(values, kind)
    # Struct by struct would go through a dictionary a turn.
    offsets, roles, texts = [0], [], []
    for turns in values:
        roles += [r for r, _ in turns or ()]
        texts += [t for _, t in turns or ()]
        offsets.append(len(roles))
    items = pa.StructArray.from_arrays([pa.array(roles, pa.string()), pa.array(texts, pa.string())], fields=list(_TURNS.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


def _batch(rows: list[dict], shape: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_column([r.get(c) for r in rows], kind) for c, kind in shape.items()], list(shape))


def _batches(rows, shape: dict, n_rows: int = PART_ROWS, n_bytes: int = PART_BYTES):
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(t) + 16 for _, t in row.get("turns") or ()) + len(row.get("codes") or b"")
        if len(held) >= n_rows or size >= n_bytes:
            yield _batch(held, shape)
            held, size = [], 0
    if held:
        yield _batch(held, shape)


def _chunks(batches):
    """Repaired conversations of a sorted partition, and chunks of those that may go beyond it.

    The first and the last conversation of a partition may; so may not those between.
    A conversation too long for memory is sent on in parts, too.
    """
    chunk = TaskContext.get().partitionId()
    now: _Chunk | None = None
    cuts: list[int] = []

    def closed(last: bool):
        if last and not now.is_open:
            now.is_open = True
        if not now.is_open:
            yield now.whole()
            return
        if now.turns or not cuts:
            cuts.append(now.sent)
            yield now.part(chunk)
        yield now.summary(chunk, list(cuts))

    for batch in batches:
        for conv_id, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns[:5])):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield from closed(False)
                now = _Chunk(conv_id, now is None)
                cuts = []
            for _ in range(copies):
                now.add(turn, role, text)
                if len(now.turns) >= PART_ROWS or now.bytes >= PART_BYTES:
                    now.is_open = True
                    cuts.append(now.sent)
                    yield now.part(chunk)
    if now is not None:
        yield from closed(True)


def _sorted(rows: DataFrame, copies: Column) -> DataFrame:
    """Conversations in order of their turns, dealt by range over the partitions.

    Rows of one turn stand by role and a hash of their text; the row number splits equal ones.
    """
    blank = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), blank)
    keyed = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), text.alias("text"),
        copies.cast("int").alias("copies"), F.xxhash64(text).alias("said"), F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "role", "said", "row"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "role", "text", "copies")


# ---------------------------------------------------------------- long conversations


def _mapped(df: DataFrame, fn, shape: dict, schema: str) -> DataFrame:
    """A function over chunks or parts of bounded size, a row at a time."""

    def of(batches):
        for batch in batches:
            rows = (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows))
            yield from _batches((r for row in rows for r in fn(row)), shape)

    return df.mapInArrow(of, schema)


def _without_repeats(chunks: DataFrame) -> DataFrame:
    """Chunks with codes and counts that know what was said in earlier chunks."""
    fresh = chunks.select("conv", "chunk", F.posexplode("digests").alias("nth", "digest"))
    first = fresh.groupBy("conv", "digest").agg(F.min("chunk").alias("earliest"), F.count(F.lit(1)).alias("n"))
    again = fresh.join(first.where("n > 1"), ["conv", "digest"]).where("chunk > earliest")
    places = again.groupBy("conv", "chunk").agg(F.collect_list("nth").alias("again"))

    def fix(row):
        codes = bytearray(row["codes"])
        again = set(row.pop("again") or ())
        nth = -1
        for k, code in enumerate(codes):
            if code:
                nth += 1
                if nth in again:
                    codes[k] = 0
                    row["truncated"] -= code > 4
                    row["duplicate"] += 1
        yield row | {"codes": bytes(codes)}

    schema = (
        "conv string, chunk long, codes binary, cuts array<long>, blank long, duplicate long, truncated long, "
        "illegal long, first string, last string, low long, high long, distinct long"
    )
    names = [column.split(" ")[0] for column in schema.split(", ")]
    found = chunks.select(*names).join(places, ["conv", "chunk"], "left")
    return pin(_mapped(found, fix, {c: _SHAPE[c] for c in names}, schema), "chunks")


_LONGS = pa.list_(pa.int64())
_VECTORS = {"conv": pa.string(), "chunk": pa.int64(), "end": _LONGS, "start": _LONGS}
_VECTORS_SCHEMA = "conv string, chunk long, end array<long>, start array<long>"


def _end_costs(chunks: DataFrame, passes: int = PASSES) -> DataFrame:
    """conv, chunk, end: the costs after each chunk, up to a constant."""
    following = F.lead("chunk").over(Window.partitionBy("conv").orderBy("chunk"))
    order = pin(chunks.select("conv", "chunk").withColumn("next", following), "order")
    codes = chunks.select("conv", "chunk", "codes")

    def speculate(row):
        yield {"conv": row["conv"], "chunk": row["chunk"], "end": END, "start": start_costs(row["codes"], END)}

    def rerun(row):
        start = fixed_up(row["codes"], row["end"], row["start"], row["wanted"])
        yield {"conv": row["conv"], "chunk": row["chunk"], "end": row["wanted"], "start": start}

    vectors = pin(_mapped(codes, speculate, _VECTORS, _VECTORS_SCHEMA), "vectors")
    end = F.array(*[F.lit(x).cast("long") for x in END])

    def leveled(v):
        return F.transform(v, lambda x: x - F.array_min(v))

    for _ in range(passes):
        after = vectors.select("conv", F.col("chunk").alias("next"), F.col("start").alias("wanted"))
        wanted = order.join(after, ["conv", "next"], "left").select("conv", "chunk", F.coalesce("wanted", end).alias("wanted"))
        stale = vectors.join(wanted, ["conv", "chunk"]).where(leveled(F.col("end")) != leveled(F.col("wanted")))
        stale = pin(stale, "stale")
        if stale.isEmpty():
            return vectors.select("conv", "chunk", "end")
        redone = _mapped(stale.join(codes, ["conv", "chunk"]), rerun, _VECTORS, _VECTORS_SCHEMA)
        kept = vectors.join(stale, ["conv", "chunk"], "left_anti")
        vectors = pin(kept.unionByName(redone), "vectors")

    # A row of 16 numbers for each partition that a conversation lies in.
    shape = {"conv": pa.string(), "chunk": pa.int64(), "costs": _LONGS}

    def matrices(row):
        yield {"conv": row["conv"], "chunk": row["chunk"], "costs": [x for v in matrix(row["codes"]) for x in v]}

    def stitch(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("chunk", "descending")]).to_pylist()
        v, out = END, []
        for row in rows:
            m = row["costs"]
            out.append({"conv": row["conv"], "chunk": row["chunk"], "end": level(v)})
            v = level([min(m[4 * p + q] + v[p] for p in range(4)) for q in range(4)])
        return pa.Table.from_pylist(out, pa.schema({"conv": pa.string(), "chunk": pa.int64(), "end": _LONGS}))

    every = _mapped(codes, matrices, shape, "conv string, chunk long, costs array<long>")
    return pin(every.groupBy("conv").applyInArrow(stitch, "conv string, chunk long, end array<long>"), "stitched")


def _entries(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """conv, chunk, end, entry (the state before its first row), is_last."""

    def exits(row):
        v = costs(row["codes"], row["end"])
        row["exits"] = [trace(row["codes"], v, q)[1] for q in range(4)]
        yield row

    def follow(table: pa.Table) -> pa.Table:
        rows = table.sort_by("chunk").to_pylist()
        state = 0
        for row in rows:
            row["entry"], row["is_last"] = state, row is rows[-1]
            state = row.pop("exits")[state]
        return pa.Table.from_pylist(rows, pa.schema({"conv": pa.string(), "chunk": pa.int64(), "end": _LONGS, "entry": pa.int32(), "is_last": pa.bool_()}))

    shape = {"conv": pa.string(), "chunk": pa.int64(), "end": _LONGS, "exits": _LONGS}
    found = _mapped(
        ends.join(chunks.select("conv", "chunk", "codes"), ["conv", "chunk"]), exits, shape,
        "conv string, chunk long, end array<long>, exits array<long>",
    )
    return found.groupBy("conv").applyInArrow(follow, "conv string, chunk long, end array<long>, entry int, is_last boolean")


def _edits(chunks: DataFrame, entries: DataFrame) -> DataFrame:
    """conv, chunk, at, ops, codes, state, tail: the edits of every part."""

    def edits(row):
        codes, state = row["codes"], row["entry"]
        ops, after = trace(codes, costs(codes, row["end"]), state)
        cuts = row["cuts"]
        for x, y in zip(cuts, [*cuts[1:], len(codes)]):
            tail = ending(after) if row["is_last"] and x == cuts[-1] else 0
            yield {"conv": row["conv"], "chunk": row["chunk"], "at": x, "ops": bytes(ops[x:y]), "codes": codes[x:y], "state": state, "tail": tail}
            for op, code in zip(ops[x:y], codes[x:y]):
                inserts, op = divmod(op, 3)
                for _ in range(inserts):
                    state = _NEXT[state]
                state = state if op == 0 else _NEXT[state] if op == 2 else _kept(code, state)

    shape = {
        "conv": pa.string(), "chunk": pa.int64(), "at": pa.int64(), "ops": pa.binary(), "codes": pa.binary(),
        "state": pa.int32(), "tail": pa.int32(),
    }
    rows = entries.join(chunks.select("conv", "chunk", "codes", "cuts"), ["conv", "chunk"])
    return _mapped(rows, edits, shape, "conv string, chunk long, at long, ops binary, codes binary, state int, tail int")


_PART = {"conv_id": pa.int64(), "conv": pa.string(), "chunk": pa.int64(), "at": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "turns": _TURNS}
_PART_SCHEMA = "conv_id long, conv string, chunk long, at long, cost long, audit string, turns array<struct<role: string, text: string>>"


def _long_parts(found: DataFrame, chunks: DataFrame, passes: int) -> DataFrame:
    """The repaired parts of conversations that lie in several partitions or are long."""
    entries = pin(_entries(chunks, _end_costs(chunks, passes)), "entries")

    def apply(row):
        turns = [(t["role"], t["text"]) for t in row["turns"]]
        repaired, audit, cost = edited(row["ops"], row["codes"], row["state"], turns, row["tail"])
        yield {c: row[c] for c in ("conv_id", "conv", "chunk", "at")} | {"turns": repaired, "audit": audit, "cost": cost}

    parts = found.where("kind = 2").select("conv_id", "conv", "chunk", "at", "turns")
    return pin(_mapped(parts.join(_edits(chunks, entries), ["conv", "chunk", "at"]), apply, _PART, _PART_SCHEMA), "parts")


def _long_reports(chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """The report row of every conversation in parts."""
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    seams = chunks.drop("codes", "cuts").withColumns(
        {"__last": F.last("last", ignorenulls=True).over(before), "__high": F.last("high", ignorenulls=True).over(before)}
    )
    joint = F.concat("__last", "first")
    broken = F.coalesce((~joint.isin(*_FINE)).cast("long"), F.lit(0))
    shared = F.coalesce((F.col("__high") == F.col("low")).cast("long"), F.lit(0))
    span = F.max("high").cast("decimal(20,0)") - F.min("low") + 1 - F.sum(F.col("distinct") - shared)
    most = F.lit((1 << 63) - 1)
    facts = seams.groupBy("conv").agg(
        F.when(span > most, most).otherwise(F.coalesce(span, F.lit(0)).cast("long")).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + broken).alias("illegal"),
    )
    pieces = F.sort_array(F.collect_list(F.struct("chunk", "at", "audit")))
    audits = parts.groupBy("conv").agg(
        F.any_value("conv_id").alias("conv_id"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
    )
    return facts.join(audits, "conv").select("conv_id", "conv", *_REPORT)


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


# ---------------------------------------------------------------- operator


def repair(rows: DataFrame, copies: Column | None = None, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(reports, turns) of conversations(conv_id, turn, role, text).

    A report is conv_id, conv, gaps, blank, duplicate, truncated, illegal, cost and audit,
    the least of the cheapest edits. turns has the repaired conversations: conv_id, conv,
    whole, chunk, at and an array of (role, text); the arrays of a conversation follow
    each other by chunk and at, and there is one where `whole`. conv tells a missing
    conv_id (one conversation of its own) from others.

    Nulls in role and text are one space. Rows of one turn stand by role and a hash of
    their text; a missing turn stands first. `copies` says how often a row stands there; a
    row of 0 copies only names its conversation. A conversation of any length is split
    over partitions, equal rows too; its texts pass in parts of bounded size. An empty
    table gives no rows. Other columns are not read.
    """
    dealt = _sorted(rows, F.lit(1) if copies is None else copies)
    found = pin(dealt.mapInArrow(lambda batches: _batches(_chunks(batches), _SHAPE), _SCHEMA), "conversations")
    chunks = _without_repeats(found.where("kind = 1"))
    parts = _long_parts(found, chunks, passes)
    whole = found.where("kind = 0")
    reports = whole.select("conv_id", "conv", *_REPORT).unionByName(_long_reports(chunks, parts))
    columns = ["conv_id", "conv", "whole", "chunk", "at", "turns"]
    none = F.lit(0).cast("long")
    turns = whole.select("conv_id", "conv", F.lit(True).alias("whole"), none.alias("chunk"), none.alias("at"), "turns")
    return reports, turns.unionByName(parts.withColumn("whole", F.lit(False)).select(*columns))


def digests(turns: DataFrame) -> DataFrame:
    """conv, repaired_sha256: SHA-256 of the lines `role:text` of each conversation.

    A digest runs from the first line to the last, so the parts of a long conversation
    stream through one task, a part at a time.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    short = turns.where("whole").select("conv", F.sha2(lines, 256).alias("repaired_sha256"))

    def streamed(batches):
        name, digest, is_first = None, None, True
        for batch in batches:
            done = []
            for conv, turns_ in zip(batch.column(0).to_pylist(), batch.column(3)):
                if conv != name:
                    if name is not None:
                        done.append((name, digest.hexdigest()))
                    name, digest, is_first = conv, hashlib.sha256(), True
                for t in turns_.as_py():
                    line = f"{t['role']}:{t['text']}"
                    digest.update((line if is_first else "\n" + line).encode())
                    is_first = False
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["conv", "repaired_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

    parts = turns.where("not whole").select("conv", "chunk", "at", "turns")
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "chunk", "at")
    return short.unionByName(ordered.mapInArrow(streamed, "conv string, repaired_sha256 string"))


def damage(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """(rows, copies): rows damaged by the CRC of `conv_id:turn`, nulls as one space.

    Of twenty remainders, 0 drops the row, 1 empties its text, 2 takes its `.!?` away, 3
    repeats it and 4 makes its role user.
    """
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    text, role = F.coalesce(F.col("text").cast("string"), blank), F.coalesce(F.col("role").cast("string"), blank)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        kind.alias("kind"),
    )
    return rows, F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """The report and the digest of every conversation, repaired after the damage.

    Gives conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256; a conversation that lost all its rows has zeros, no edits and the
    digest of nothing.
    """
    reports, turns = repair(*damage(conversations))
    return reports.join(digests(turns), "conv").select("conv_id", *_REPORT, "repaired_sha256")
