"""Blocks of documents that ask buckets of keys.

Texts are dealt to blocks of about equal bytes. A block sends each bucket of the key
space what it wants to know about its distinct keys, and gets back an answer. Both
numbers grow with the bytes, so that a block or a bucket has a bounded size whatever
the input; and a key that a third of all documents have is sent once a block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 4 << 20


def count_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def in_blocks(docs: DataFrame, n_blocks: int, carry: bool = False) -> DataFrame:
    """doc_id, text and the block of each document; with `carry`, all its columns as `rest`."""
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")
    columns = [block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
    return docs.select(*columns)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where equal keys begin in a sorted array, and where each such run ends."""
    if not len(keys):
        none = np.zeros(0, np.int64)
        return none, none
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.append(starts[1:], len(keys))


def parts(bodies, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Binary bodies as one array, and the number of the body of each value."""
    arrays = [np.frombuffer(b, dtype) for b in bodies]
    if not arrays:
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    return np.concatenate(arrays), np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
