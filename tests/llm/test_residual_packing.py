"""Hierarchical residual packing against the tokenizer and plain best fit."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from test_operators import DOCS, LONG, ODD, SMALL, counted, texts

from carryall.llm import residual_packing
from carryall.llm.subwords import tokenizer_path


@pytest.fixture(scope="module")
def plain():
    """The tokenizer itself, with an end after each document."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def check(df, plain, **options):
    capacity = options.get("capacity", 1024)
    out = residual_packing.pack(df, **options).collect()
    want = []
    for doc_id, text in texts(df):
        ids = plain(text)
        rest = len(ids) % capacity
        cuts = [0] + ([rest] if rest else []) + list(range(rest + capacity, len(ids) + 1, capacity))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert counted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == counted(want)
    held = {}
    for r in out:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(r.length for r in out)


def test_pieces_and_places(spark, plain):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    n, total = check(df, plain)
    assert n <= 1.03 * -(-total // 1024)
    # Many small groups and several rounds of merging: few sequences more.
    m, _ = check(df, plain, group=8)
    assert n <= m <= 1.1 * n


def test_odd_tables(spark, plain):
    odd = spark.createDataFrame(ODD, DOCS)
    check(odd, plain)
    check(odd, plain, capacity=64, group=4)
    assert residual_packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    assert residual_packing.pack(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 1


def test_repeated_rows_are_dealt_over_groups(spark, plain):
    """A third of all rows are one row: groups keep their size, and nothing is lost."""
    rows = [(None if k % 3 else 7, "the same few words" if k % 3 else f"text number {k} " * (k % 40)) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, plain, group=32)
    pieces = residual_packing._pieces(df, tokenizer_path("byte_bpe_50k.json"), 2, 1024)
    assert pieces.select("item").distinct().count() == pieces.count() == 600


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(20):
        capacity = int(rng.integers(5, 60))
        sizes = rng.integers(1, capacity + 1, 80).tolist()
        bins, places, fills = residual_packing.best_fit(sizes, capacity)
        slow = []
        for size, b, place in zip(sizes, bins, places):
            fitting = [f for f in slow if f + size <= capacity]
            if fitting:
                assert place == max(fitting) == slow[b]
                slow[b] += size
            else:
                assert b == len(slow) and place == 0
                slow.append(size)
        assert slow == fills


def test_long_texts_are_cut_after_a_short_first_piece(spark, plain):
    n = len(plain(LONG))
    out = residual_packing.pack(spark.createDataFrame([(1, LONG)], "doc_id long, text string")).orderBy("piece").collect()
    assert [r.length for r in out] == [n % 1024 or 1024] + [1024] * ((n - 1) // 1024)
    assert [residual_packing.pieces_of(k, 4) for k in (1, 4, 5)] == [[(0, 1)], [(0, 4)], [(0, 1), (1, 4)]]
