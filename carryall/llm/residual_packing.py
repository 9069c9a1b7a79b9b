"""Whole documents packed into few sequences, by hierarchical residual packing.

Only documents longer than a sequence are cut. Pieces are dealt to groups of bounded
size, each of which packs its own by best fit, longest first. Bins that are nearly full
are done. The others are the items of the next round, in which neighbouring groups are
merged: a bin moves as one item, with all it holds. Rounds go on up the tree of groups
until a single group is left, or a round saves almost nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carryall.llm.subwords import BYTE_BPE, encoder, tokenizer_path
from carryall.sources.tables import pin

CAPACITY = 1024
END = 2
# Items in a group, on average.
GROUP = 16_384
# Ids that a bin may lack and still count as nearly full.
SLACK = 4
# A later round that makes its bins fewer by less than this share is the last.
LEAST_GAIN = 0.001

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACE = "bin long, place long, fill long, leads boolean"


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; the first takes what is over."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(docs: DataFrame, path: str, end: int, capacity: int) -> DataFrame:
    def of(batches):
        enc, stop = encoder(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode([text.as_py() or ""])[0] + stop
                for k, (s, n) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            doc_ids, *numbers = zip(*rows) if rows else [[]] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), *[pa.array(c, kind) for c, kind in zip(numbers, kinds)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Numbered before they are written: repeated rows are told apart, and stay so.
    return rows.mapInArrow(of, _PIECE).withColumn("item", F.monotonically_increasing_id())


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, its place in the bin, fill of each bin), items taken in order.

    An item goes to the bin with the least room that takes it. The rooms that occur are
    the bits of one number, so the least of them is found without a search.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    bins, places, fills = [], [], []
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins.append(b)
        places.append(fills[b])
        fills[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, places, fills


def _fit(table: pa.Table, level: int, capacity: int) -> pa.Table:
    """The items of one group with their bin, their place in it and its fill."""
    order = table.sort_by([("length", "descending"), ("item", "ascending")])
    bins, places, fills = best_fit(order["length"].to_pylist(), capacity)
    at = np.array(bins, np.int64)
    numbers = (level << 56) | (table["grp"][0].as_py() << 28)
    place = np.array(places, np.int64)
    return (
        order.append_column("bin", pa.array(at + numbers))
        .append_column("place", pa.array(place))
        .append_column("fill", pa.array(np.array(fills, np.int64)[at]))
        .append_column("leads", pa.array(place == 0))
    )


def _round(items: DataFrame, level: int, capacity: int) -> DataFrame:
    schema = ", ".join(f"`{name}` {kind}" for name, kind in items.dtypes) + ", " + _PLACE
    fitted = items.groupBy("grp").applyInArrow(lambda t: _fit(t, level, capacity), schema)
    return pin(fitted, f"round{level}")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end: int = END,
    tokenizer: str = BYTE_BPE,
    group: int = GROUP,
    slack: int = SLACK,
) -> DataFrame:
    """Every piece of every document, with its sequence and its place there.

    Gives doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its
    ids and then `end`; a null or empty text is `end` alone. A document of up to
    `capacity` ids, that one counted, is one piece. A longer one is cut into pieces of
    `capacity`, of which the first may be shorter; very long texts are encoded whole.
    Pieces of full length are sequences of their own. A row without doc_id is packed like
    any other and repeated rows are packed each, in groups by row number, so that no
    group grows with the copies. Among pieces of one length the row number decides. An
    empty table gives no pieces. Other columns are not read.
    """
    found = pin(_pieces(docs, tokenizer_path(tokenizer), end, capacity), "pieces")
    is_full = F.col("length") == capacity
    n_items = found.where(~is_full).count()
    n_groups = max(1, -(-n_items // group))
    items = found.where(~is_full).withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(n_groups)))
    rounds = [_round(items, 1, capacity)]
    while n_groups > 1:
        under = rounds[-1].where(F.col("leads") & (F.col("fill") < capacity - slack))
        n_items = under.count()
        n_next = max(1, min(n_groups // 2, -(-n_items // group)))
        merged = F.floor(F.col("grp") * n_next / n_groups).cast("long")
        items = under.select(F.col("bin").alias("item"), F.col("fill").alias("length"), merged.alias("grp"))
        rounds.append(_round(items, len(rounds) + 1, capacity))
        saved = n_items - rounds[-1].where("leads").count()
        n_groups = n_next
        if saved < LEAST_GAIN * n_items:
            break
    # From the last round down: where a bin ended up is where all it holds ended up.
    final = None
    for step in reversed(rounds[1:]):
        step = step.select("item", "bin", "place")
        final = step if final is None else _moved(step, final)
    placed = rounds[0] if final is None else _moved(rounds[0], final)
    own = found.where(is_full).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.col("bin").alias("sequence_id"), F.col("place").alias("offset"),
    ).unionByName(own)


def _moved(step: DataFrame, final: DataFrame) -> DataFrame:
    """A round's items where its bins are in the end."""
    ends = final.select(F.col("item").alias("bin"), F.col("bin").alias("__bin"), F.col("place").alias("__place"))
    return step.join(ends, "bin", "left").withColumns(
        {
            "bin": F.coalesce("__bin", "bin"),
            "place": F.col("place") + F.coalesce("__place", F.lit(0).cast("long")),
        }
    ).drop("__bin", "__place")
