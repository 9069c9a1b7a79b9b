from __future__ import annotations

import random

import numpy as np
import pytest

from carryall.llm import subwords

NAMES = [subwords.BYTE_BPE, subwords.WORD_BPE]


@pytest.mark.parametrize("name", NAMES)
def test_a_mark_behind_a_word_makes_no_further_piece(name):
    enc = subwords.Encoder(subwords.tokenizer_path(name))
    enc.encode([f"start {' '.join(f'word{mark}' for mark in ('', ',', '.', '!', '?', ';', ':'))}\nword.\nword"])
    assert [p for p in enc.known if "word" in p and p[-1] in ",.!?;:"] == []
    whole = []
    enc._whole = lambda texts: whole.extend(texts) or [b"" for _ in texts]
    enc.encode(["start ofword%%% moreword,$$$ lessword***"])
    assert not [t for t in whole if "word" in t]


@pytest.mark.parametrize("name", NAMES)
def test_marks_and_blanks_in_any_order_give_the_ids_of_the_library(name):
    rng = random.Random(5)
    enc = subwords.Encoder(subwords.tokenizer_path(name))
    some = [*"aéÿßª·²7日İΣς😀_-'|$(\x00\x1c\xa0\t\r​́", "Be", "'s", "%%%", "?!", "12", *",.;:!?" * 2, *" \n" * 6]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 14))) for _ in range(20_000)]
    words, marks = ["alpha", "Be", "é", "bÿz", "ª", "12"], ["", "", ",", ".", "?!", "%%%,", ",%", "'s,", "_,", "日,", "²,"]
    texts += ["".join(rng.choice(words) + rng.choice(marks) + rng.choice(" \n") for _ in range(rng.randint(1, 8)))[:-1] for _ in range(10_000)]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == want
