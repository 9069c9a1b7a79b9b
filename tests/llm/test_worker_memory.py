from __future__ import annotations

import numpy as np
import pyarrow as pa

from carryall.llm import quality, subwords


def test_quality_begins_without_the_encoders_of_other_operators(monkeypatch):
    monkeypatch.setattr(subwords, "_ENCODERS", {"p": "an encoder"})
    texts = ["a" * 400_000] * 9 + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["doc_id", "text"])
    parts = list(quality._slices([batch]))
    assert not subwords._ENCODERS
    assert [i for part in parts for i in part.column(0).to_pylist()] == list(range(10))
    assert max(part.num_rows for part in parts) * 400_000 <= 1 << 21


def test_an_encoder_remembers_as_many_pieces_as_it_is_given(monkeypatch):
    monkeypatch.setattr(subwords, "_ENCODERS", {})
    path = subwords.tokenizer_path(subwords.WORD_BPE)
    enc = subwords.encoder(path, 50)
    assert subwords.encoder(path, 50) is enc
    texts = [f"word{k} other{k} third{k}" for k in range(200)]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, want):
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == ids
        assert len(enc.known) <= 50 + 6 and len(enc.older) <= 50 + 6
    assert subwords.encoder(path) is not enc and len(subwords._ENCODERS) == 1
