"""The longest verbatim matches of benchmark items, with their places."""

from __future__ import annotations

import re

import pytest

from carryall.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def matches(a, b):
    """(words, start in a, start in b) of all maximal common runs."""
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and (not i or not j or a[i - 1] != b[j - 1]):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                yield n, i, j


DOCS = [
    (1, "start " + " ".join(f"q{k}" for k in range(40)) + " end a b c"),
    (2, " ".join(f"q{k}" for k in range(5, 30)) + " gap " + " ".join(f"q{k}" for k in range(20, 33))),
    (3, "Short Item here and x1 x2 x3 nothing else"),
    (4, None),
    (5, ""),
    (None, " ".join(f"q{k}" for k in range(40))),
    (6, "z " * 40),
    (7, " ".join(f"r{k}" for k in range(14)) + " " + " ".join(f"q{k}" for k in range(13))),
]
ITEMS = [
    (10, " ".join(f"q{k}" for k in range(36))),
    (11, "short item here"),
    (12, "x2 x3 x4 and x1 x2 x3 x5 " + " ".join(f"n{k}" for k in range(20))),
    (13, "z " * 15),
    (14, None),
    (15, "unseen words only"),
    (None, " ".join(f"r{k}" for k in range(14))),
]


@pytest.mark.parametrize("query_bytes", [1 << 20, 60])
def test_matches_are_as_long_as_they_go(spark, query_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.longest_matches(docs, items, query_bytes=query_bytes).collect()}
    want = set()
    for item, text in ITEMS:
        every = [(-n, d is None, d or 0, i, j) for d, t in DOCS for n, i, j in matches(words(t), words(text))]
        if every and item is not None:
            n, none, d, i, j = min(every)
            want.add((item, -n, None if none else d, i, j))
    assert got == want
    rows = decontaminate.contamination(docs, items, query_bytes=query_bytes).collect()
    found = {r.doc_id: (r.longest_match, r.match_start, r.match_item, r.match_item_start) for r in rows}
    for d, t in DOCS:
        every = [
            (-n, i, item is None, item or 0, j)
            for item, text in ITEMS
            for n, i, j in matches(words(t), words(text))
            if n >= min(13, len(words(text)))
        ]
        n, i, none, item, j = min(every) if every else (0, None, True, 0, None)
        assert found[d] == (-n, i, None if none else item, j)
