"""Documents packed into windows of equal length, by Karmarkar-Karp differencing.

Every document is cut into full windows, which stand alone, and a rest. Rests are
dealt to groups of bounded size; in each, multiway differencing starts with a partial
partition for every rest and merges the two that are most uneven, the fullest window
of one onto the emptiest of the other, until one near-equal partition is left. Where
its fullest window exceeds the capacity, there is one window more.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carryall.llm.subwords import WORD_BPE, encoder, tokenizer_path
from carryall.sources.tables import pin

CAPACITY = 2048
END = 1
# Rests in a group, on average.
GROUP = 1024
# A rest is cut into pieces of at most this many ids, so that windows can be filled.
PIECE = 512


def pieces_of(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    full = n // capacity * capacity
    out = [(s, capacity) for s in range(0, full, capacity)]
    return out + [(s, min(piece, n - s)) for s in range(full, n, piece)]


def _pieces(docs: DataFrame, path: str, end: int, capacity: int, piece: int, remembered: int | None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece."""

    def of(batches):
        enc, stop = encoder(path, remembered), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode([text.as_py() or ""])[0] + stop
                n = len(ids) // 4
                rows += [(doc_id, s, k, zlib.crc32(ids[4 * s : 4 * (s + k)]), n) for s, k in pieces_of(n, capacity, piece)]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """The items of each of m windows, by multiway differencing of all sizes."""
    # A partial partition: the sums of its windows above the least, in falling order
    # (windows at the least are left out), and the items of those windows.
    heap = [(-s, k, [s], [[k]]) for k, s in enumerate(sizes) if s]
    heapq.heapify(heap)
    if not heap:
        return [[] for _ in range(m)]
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, ai = heapq.heappop(heap)
        _, _, b, bi = heapq.heappop(heap)
        if len(a) + len(b) <= m:
            # No two filled windows have to meet.
            sums, items = a + b, ai + bi
        else:
            a, ai = a + [0] * (m - len(a)), ai + [[] for _ in range(m - len(ai))]
            b, bi = b + [0] * (m - len(b)), bi + [[] for _ in range(m - len(bi))]
            sums = [x + y for x, y in zip(a, reversed(b))]
            items = [x + y for x, y in zip(ai, reversed(bi))]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[k] for k in order], [items[k] for k in order]
        if len(sums) == m:
            least = sums[-1]
            sums = [s - least for s in sums]
        heapq.heappush(heap, (-sums[0], serial, sums, items))
        serial += 1
    _, _, _, items = heap[0]
    return items + [[] for _ in range(m - len(items))]


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`; the fewest for which differencing fits."""
    total = sum(sizes)
    m = max(1, -(-total // capacity))
    while True:
        found = differencing(sizes, m)
        over = sum(max(0, sum(sizes[k] for k in w) - capacity) for w in found)
        if not over:
            return [w for w in found if w]
        m += max(1, over // capacity)


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    order = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
    sizes = order["length"].to_pylist()
    sequence = np.zeros(len(sizes), np.int64)
    offset = np.zeros(len(sizes), np.int64)
    group = table["grp"][0].as_py()
    for w, items in enumerate(windows_of(sizes, capacity)):
        at = 0
        for k in sorted(items):
            sequence[k], offset[k] = (group << 20) | w, at
            at += sizes[k]
    out = order.drop_columns(["grp"])
    return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end: int = END,
    tokenizer: str = WORD_BPE,
    group: int = GROUP,
    piece: int = PIECE,
    remembered: int | None = None,
) -> DataFrame:
    """Every piece of every document, with its window and its place there.

    Gives doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A
    document is its ids and then `end`; a null or empty text is `end` alone. Full
    windows are windows of their own, with sequence_ids from 2**62 on. A row without doc_id
    is packed like any other; repeated rows are packed each. An empty table gives no
    pieces. Other columns are not read. `remembered`: pieces of text whose ids a
    worker keeps, for speed alone.
    """
    numbered = _pieces(docs, tokenizer_path(tokenizer), end, capacity, piece, remembered).withColumn("row", F.monotonically_increasing_id())
    found = pin(numbered, "pieces")
    is_full = F.col("length") == capacity
    n = max(1, found.where(~is_full).count() // group)
    # By the number of the row, as it was written: repeated rows are spread like any others.
    key = F.pmod(F.xxhash64("row"), F.lit(n))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rests = found.where(~is_full).withColumn("grp", key).drop("row").groupBy("grp").applyInArrow(lambda t: _pack(t, capacity), schema)
    full = found.where(is_full).drop("row").select(
        "*", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return rests.unionByName(full)
