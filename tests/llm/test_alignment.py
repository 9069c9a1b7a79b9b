"""Cross-tokenizer alignment against a plain version."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from test_operators import DOCS, ODD, SMALL, counted, texts

from carryall.llm import alignment
from carryall.llm.subwords import tokenizer_path


@pytest.fixture(scope="module")
def slow_tokens():
    """Tokens of both tokenizers as (ids, bytes), from the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(x): x for x in prints}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in prints)}

    def tokens(text):
        if not text:
            return [], [], [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        spelled = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids]
        other = b.encode(text)
        pieces = [b.id_to_piece(i) for i in other]
        written = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(other, pieces)]
        if b"".join(spelled) != (" " + text).encode() or b"".join(written) != (" " + text).encode():
            return [], [], [], []
        return ids, spelled, other, written

    return tokens


def slow_groups(tokens):
    ids, spelled, other, written = tokens
    ends_a, ends_b = np.cumsum([len(x) for x in spelled]).tolist(), np.cumsum([len(x) for x in written]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append((ids[i:x], other[j:y]))
        i, j = x, y
    return groups


def slow_counts(rows, tokens):
    groups = [slow_groups(tokens(t)) for _, t in rows]
    links = [collections.Counter((a, b) for x, y in gs for a in x for b in y) for gs in groups]
    held = collections.Counter(p for c in links for p in c)
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for (doc_id, _), gs, c in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append(
            (
                doc_id,
                sum(len(x) for x, _ in gs),
                sum(len(y) for _, y in gs),
                len(gs),
                sum(c.values()),
                sum(n for p, n in c.items() if held[p] == top[p[0]]),
                sum(n * held[p] for p, n in c.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
STRANGE = [
    "<|endoftext|> and <s> are </s> plain <unk> text",
    "▁ is a blank to one of them",
    "  two  blanks\t\ttabs\r\nlines\n\n\n",
    "日本語の文章です。", "🙂🙃 naïve été \x00 \x7f", " leading", "a", " ", "\n",
    "x" * 5000, "ab" * 3000 + "é" * 700, "1234567890" * 300, "　 ﻿",
]


def check(df, tokens):
    got = alignment.link_counts(df)
    assert got.columns == COLUMNS
    assert counted(got.collect()) == counted(slow_counts(texts(df), tokens))


def test_link_counts(spark, slow_tokens, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(df, slow_tokens)
    # Blocks of a few documents, and several copies of the counts.
    monkeypatch.setattr(alignment, "BLOCKS_A_COPY", 2)
    rows = [(k, t) for k, (_, t) in enumerate(texts(df)[:60])]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(12), slow_tokens)


def test_link_counts_of_odd_texts(spark, slow_tokens):
    rows = ODD + [(100 + k, t, "en", "s", 1, 1, "x", "y") for k, t in enumerate(STRANGE)]
    check(spark.createDataFrame(rows, DOCS), slow_tokens)
    assert alignment.link_counts(spark.createDataFrame([], DOCS)).count() == 0
    nothing = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert counted(alignment.link_counts(nothing).collect()) == counted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")])


def test_alignments_give_tokens_and_groups(spark, slow_tokens):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(STRANGE + [None])], "doc_id long, text string")
    for r in alignment.alignments(df).collect():
        want = slow_groups(slow_tokens((STRANGE + [None])[r.doc_id]))
        a, b = [0, *r.a_stops], [0, *r.b_stops]
        assert [(r.a_ids[w:x], r.b_ids[y:z]) for w, x, y, z in zip(a, a[1:], b, b[1:])] == want


def test_lanes_and_wide_groups():
    """Ends that seldom meet, in lanes of any length; groups beyond the pairwise limit."""
    rng = np.random.default_rng(3)
    for lane in (1, 3, 512):
        sizes = [int(n) for n in rng.integers(1, 400, 12)]
        a_all, b_all, a_bounds, b_bounds, at = [], [], [0], [0], 0
        for n in sizes:
            for ends, bounds in ((a_all, a_bounds), (b_all, b_bounds)):
                some = rng.choice(np.arange(1, n), int(rng.integers(0, n)), False) if n > 1 else []
                ends += sorted({at + n, *(at + int(x) for x in some)})
                bounds.append(len(ends))
            at += n
        a_ends, b_ends = np.array(a_all), np.array(b_all)
        links, a_cut, b_cut = alignment.lockstep(a_ends, b_ends, np.array(a_bounds), np.array(b_bounds), lane)
        assert a_ends[a_cut].tolist() == b_ends[b_cut].tolist() == sorted(set(a_all) & set(b_all))
        found = [(int(x), int(y)) for i, j in links for x, y in zip(i, j)]
        starts_a, starts_b = [0, *a_all], [0, *b_all]
        want = {(i, j) for i in range(len(a_all)) for j in range(len(b_all)) if starts_a[i] < b_all[j] and starts_b[j] < a_all[i]}
        assert len(found) == len(set(found)) and set(found) == want
    # One group of 300 x 200 tokens: counted by distinct ids.
    a, b = rng.integers(0, 5, 300), rng.integers(0, 7, 200)
    one = np.array([0, 1])
    block = alignment.Aligned(a, b, 300 * one, 200 * one, np.array([300]), np.array([200]), one, [])
    text, pair, times = alignment.linked_pairs(block, 7)
    want = collections.Counter((int(x) * 7 + int(y)) for x in a for y in b)
    assert dict(zip(pair.tolist(), times.tolist())) == want and not text.any()
