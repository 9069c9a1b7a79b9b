"""Near-duplicate texts by SimHash, every pair of fingerprints within reach compared.

Distinct fingerprints are compared exactly, tile against tile, with exclusive-or and
bit counts. Two fingerprints whose bit counts differ by more than the radius cannot
be within it, in whole or summed over segments; so tiles are cut along the bit counts
of halves and bytes, and tile pairs too far apart are skipped. Of the links found in
a pair of tiles only a spanning forest leaves it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from carryall.llm.components import connected_components, roots, unite
from carryall.sources.tables import pin

SHINGLE = 3
RADIUS = 3
SEED = 42
# Distinct fingerprints of one class that are compared in one task at a time.
CLASS_ROWS = 65_536
_TILE = 256
_HALF = 33


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a text; zero where it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[k - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp as a signed 64-bit number."""

    def of(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, fp long")


def _bits(fp):
    return F.bit_count(fp).cast("int")


def _tiles(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of fingerprints, and the least and largest bit counts by byte of each tile."""
    by_byte = np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int16)
    order = np.lexsort(by_byte.T)
    cut = np.arange(0, len(fps), _TILE)
    return order, np.minimum.reduceat(by_byte[order], cut), np.maximum.reduceat(by_byte[order], cut)


def near_pairs(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS):
    """(i, j) arrays, a tile pair at a time: left[i] and right[j] differ in at most `radius` bits.

    Without `right`, pairs within `left`, each once.
    """
    other = left if right is None else right
    if not len(left) or not len(other):
        return
    lo, lmin, lmax = _tiles(left)
    ro, rmin, rmax = _tiles(other)
    for t in range(len(lmin)):
        apart = np.maximum(0, np.maximum(rmin - lmax[t], lmin[t] - rmax)).sum(1)
        a = lo[t * _TILE : (t + 1) * _TILE]
        for u in np.flatnonzero(apart <= radius):
            if right is None and u < t:
                continue
            b = ro[u * _TILE : (u + 1) * _TILE]
            near = np.bitwise_count(left[a][:, None] ^ other[b][None, :]) <= radius
            if right is None and u == t:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            if len(i):
                yield a[i], b[j]


def _forest(table: pa.Table, radius: int) -> pa.Table:
    side = table["side"].to_numpy()
    fp = table["fp"].to_numpy().view(np.uint64)
    rep = table["rep"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    same = bool(table["same"][0].as_py())
    parent = np.arange(len(fp))
    for i, j in near_pairs(fp[left], None if same else fp[right], radius):
        unite(parent, left[i], (left if same else right)[j])
    top = roots(parent, np.arange(len(fp)))
    below = np.flatnonzero(top != np.arange(len(fp)))
    return pa.table({"a": rep[below], "b": rep[top[below]]})


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the `rep` of distinct fingerprints (fp, rep).

    They join the same nodes as all pairs within the radius do. A class is all
    fingerprints with the same bit counts of both halves. A class of more than
    CLASS_ROWS is cut into parts by hash; all pairs of parts are compared.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    classed = distinct.select("fp", "rep", (_bits(high) * _HALF + _bits(low)).alias("c"))
    sizes = {r["c"]: -(-r["n"] // CLASS_ROWS) for r in classed.groupBy("c").agg(F.count("*").alias("n")).collect()}

    def near(c: int, d: int) -> bool:
        return abs(c // _HALF - d // _HALF) + abs(c % _HALF - d % _HALF) <= radius

    # At most 33 x 33 classes, each with the classes in reach and their parts: a table
    # of that size whatever the input. The pairs of parts are made from it in Spark.
    plan = [(c, n, [{"c": d, "n": m} for d, m in sizes.items() if near(c, d)]) for c, n in sizes.items()]
    mates = distinct.sparkSession.createDataFrame(plan, "c int, n int, mates array<struct<c int, n int>>")
    mine = F.struct(F.col("c").alias("c"), F.col("part").alias("part"))
    other = F.struct(F.col("mate.c").alias("c"), F.col("q").alias("part"))
    dealt = (
        classed.join(F.broadcast(mates), "c")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
        .select("fp", "rep", "c", "part", F.explode("mates").alias("mate"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("mate.n") - 1)))
        .select(
            "fp",
            "rep",
            F.least(mine, other).alias("one"),
            F.greatest(mine, other).alias("two"),
            F.when(mine <= other, 0).otherwise(1).alias("side"),
            (mine == other).alias("same"),
        )
    )
    return dealt.groupBy("one", "two").applyInArrow(lambda t: _forest(t, radius), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Documents link where their fingerprints differ in at most `radius` bits; a
    component is named by its least doc_id. A null or wordless text has the
    fingerprint zero and links like any other. A row without doc_id gets its
    fingerprint, but links nothing and has no component. Repeated rows give repeated
    results; an empty table gives none. Other columns are not read.
    """
    fps = pin(fingerprints(docs, width), "fingerprints")
    distinct = pin(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    found = connected_components(fingerprint_links(distinct, radius))
    named = distinct.join(found, distinct["rep"] == found["node"], "left").select(
        F.col("fp"), F.coalesce("component", "rep").alias("component_id")
    )
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(named, "fp", "left").select(
        "doc_id", hex16.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without those that have a near copy with a smaller doc_id in their component.

    Rows of one doc_id are one document and stay or go together; rows without stay.
    """
    gone = near_duplicates(docs, width, radius).where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
