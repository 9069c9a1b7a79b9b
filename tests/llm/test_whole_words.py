"""Language scores sum over all segmentations of whole words."""

from __future__ import annotations

import numpy as np

from carryall.llm import language
from carryall.llm.subwords import tokenizer_path


def slow_log(word, pieces, p):
    """Log of the sum over all segmentations, one place after the other."""
    at = np.full(len(word) + 1, -np.inf)
    at[0] = 0
    where = {q: k for k, q in enumerate(pieces)}
    longest = max(map(len, pieces))
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            k = where.get(word[start:end])
            if k is not None:
                at[end] = np.logaddexp(at[end], at[start] + np.log(p[k]))
    return at[-1]


def test_words_of_any_length_are_summed_over_whole():
    pieces = language.vocabulary_pieces(tokenizer_path(language.VOCABULARY))
    assert max(map(len, pieces)) > 12 and b" international" in pieces
    p = np.random.default_rng(3).random((len(pieces), 2)) / len(pieces)
    model = language.Model(["x", "y"], language.Pieces(pieces), p)
    words = [b" a", b" international", b" relationships", " 日本語の文章には空白がない".encode() * 9, b" " + b"configuration" * 80, " naïve".encode()]
    words[3] = b" " + words[3].replace(b" ", b"")
    got = np.zeros((len(words), 2))
    for some, rows, sizes in language.by_size(words):
        got[some] = model.words(rows, sizes)
    want = [[slow_log(w, pieces, p[:, k]) for k in range(2)] for w in words]
    assert np.isfinite(got).all() and np.allclose(got, want)


def test_training_counts_segmentations_by_their_share():
    pieces = [b" ", b"a", b"ab", b"b", b" a"]
    words, counts = [b"ab", b"a", b"ab" * 200], np.array([3, 2, 1])

    def cuts(w):
        return [[]] if not w else [[k, *rest] for k, q in enumerate(pieces) if w.startswith(q) for rest in cuts(w[len(q) :])]

    start = np.zeros(len(pieces))
    for w, n in zip([b" ab", b" a", b" " + b"ab" * 200], counts):
        for k, q in enumerate(pieces):
            start[k] += n * sum(w.startswith(q, i) for i in range(len(w)))
    p = (start + 0.01) / (start.sum() + 0.01 * len(pieces))
    assert np.allclose(language.train_pieces(language.Pieces(pieces), len(pieces), words, counts, rounds=0), p)
    # One round on words short enough to list all their segmentations.
    expected = np.zeros(len(pieces))
    start = np.zeros(len(pieces))
    for w, n in ((b" ab", 3), (b" a", 2)):
        for k, q in enumerate(pieces):
            start[k] += n * sum(w.startswith(q, i) for i in range(len(w)))
    p = (start + 0.01) / (start.sum() + 0.01 * len(pieces))
    for w, n in ((b" ab", 3), (b" a", 2)):
        found = [(np.prod(p[c]), c) for c in cuts(w)]
        for q, c in found:
            np.add.at(expected, c, n * q / sum(x for x, _ in found))
    want = (expected + 0.01) / (expected.sum() + 0.01 * len(pieces))
    got = language.train_pieces(language.Pieces(pieces), len(pieces), words[:2], counts[:2], rounds=1)
    assert np.allclose(got, want)
    assert np.isfinite(language.train_pieces(language.Pieces(pieces), len(pieces), words, counts)).all()
