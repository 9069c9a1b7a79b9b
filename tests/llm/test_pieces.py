from __future__ import annotations

import collections

import numpy as np
import pytest

from carryall.llm import subwords

TEXTS = ["alpha beta alpha, beta. alpha!\nalpha beta's 12 é", "alpha beta", "gamma, alpha\tbeta"]


class Counting:
    def __init__(self, model):
        self.model, self.seen = model, collections.Counter()

    def tokenize(self, text):
        self.seen[text] += 1
        return self.model.tokenize(text)


@pytest.mark.parametrize("name", [subwords.BYTE_BPE, subwords.WORD_BPE])
def test_a_piece_is_learned_once_as_it_is_looked_up(name, monkeypatch):
    enc = subwords.Encoder(subwords.tokenizer_path(name))
    enc.model = Counting(enc.model)
    want = [e.ids for e in enc.tokenizer.encode_batch(TEXTS, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(TEXTS)] == want
    assert enc.model.seen and set(enc.model.seen.values()) == {1}
    # Of two generations of pieces, the older one is taken over and not learned again.
    monkeypatch.setattr(subwords, "_REMEMBERED", 0)
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(TEXTS[1:2])] == want[1:2]
    assert set(enc.model.seen.values()) == {1} and len(enc.known) == 2


def test_a_worker_gives_freed_memory_back_before_it_loads_an_encoder(monkeypatch):
    calls = []
    monkeypatch.setattr(subwords, "released", lambda: calls.append(1))
    monkeypatch.setattr(subwords, "_ENCODERS", {})
    path = subwords.tokenizer_path(subwords.WORD_BPE)
    assert subwords.encoder(path) is subwords.encoder(path) and len(calls) == 1
    subwords.forget()
    assert len(calls) == 2 and not subwords._ENCODERS
