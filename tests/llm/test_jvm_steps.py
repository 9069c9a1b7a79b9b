from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from carryall.llm import attention_lm as lm
from carryall.llm import jvm, subwords


@pytest.fixture(scope="module")
def texts(spark):
    """Windows that are full, cut short and lacking; repeated rows, nulls, classes that are shared."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("the", "on", "sta", "wh", "é", "日") for b in ("", "ing", "er", "ou", "7", ".")]
    rows = [(k, " ".join(rng.choice(words, k % 50 * 3))) for k in range(300)]
    rows += [(7, None), (8, ""), (9, "again and again"), (9, "again and again"), (None, "nobody"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_steps_are_compiled_here(spark):
    assert lm._steps(spark) is not None
    assert jvm.steps(spark, "any") is lm._steps(spark)


def test_counts_and_weights_are_those_of_numpy(spark, texts, monkeypatch):
    ids = lm.pin(lm._training_ids(texts, lm.tokenizer_path(lm.WORD_BPE)), "ids")
    sc = spark.sparkContext
    found = []
    for _ in range(2):
        counts = lm._counted(ids, 50_000)
        shared = sc.broadcast(lm.Vocabulary.of(counts).classes)
        pairs = lm._counted(ids, (lm.CLASSES + 1) * lm.CLASSES, shared)
        model = lm.AttentionModel(pairs.reshape(lm.CLASSES + 1, lm.CLASSES))
        for k in ("q", "k"):
            # Scores of attention on both sides of their bound.
            model.w[k] *= 12
        fitted = [lm._fitted(ids, shared, sc.broadcast(model), r).toPandas() for r in (0, 2)]
        found.append((counts, pairs, fitted, model.flat()))
        monkeypatch.setattr(lm, "_steps", lambda spark: None)
    (counts, pairs, fitted, start), (counts_np, pairs_np, fitted_np, _) = found
    assert (counts == counts_np).all() and (pairs == pairs_np).all()
    for a, b in zip(fitted, fitted_np):
        a, b = (x.sort_values(["k", "weight", "value"]).reset_index(drop=True) for x in (a, b))
        assert (a["k"] == b["k"]).all() and (a["weight"] == b["weight"]).all()
        apart = (a["value"] - b["value"]).abs()
        assert apart.mean() < 1e-5 and apart.max() < 0.01
        assert np.abs(a["value"].to_numpy() - start[a["k"]]).max() > 0.02


def test_scores_are_those_of_numpy(spark, texts, monkeypatch):
    path = lm.tokenizer_path(lm.WORD_BPE)
    rows = lm.pin(lm._prepared(texts, path, 1), "texts").where("ids is not null")
    rng = np.random.default_rng(6)
    vocabulary = lm.Vocabulary.of(rng.random(lm.encoder(path).tokenizer.get_vocab_size() + 1))
    for scale in (0.3, 2):
        # The larger weights give logits that need a shift, which NumPy does not give them.
        model = lm.AttentionModel(rng.random((lm.CLASSES + 1, lm.CLASSES)))
        for k, w in model.w.items():
            model.w[k] = (rng.normal(size=w.shape) * scale).astype(np.float32)
        with monkeypatch.context() as m:
            got = lm._scored(rows, vocabulary, model).toPandas()
            m.setattr(lm, "_steps", lambda spark: None)
            want = lm._scored(rows, vocabulary, model).toPandas()
        assert len(got) == len(want) == 306
        key = lambda x: x.assign(words=x["words"].map(bytes)).sort_values(["doc_id", "words"])["score"].to_numpy()
        got, want = key(got), key(want)
        fine = np.isfinite(want)
        assert np.isfinite(got).all() and np.allclose(got[fine], want[fine], rtol=2e-5) and (fine.all() or scale > 1)


def test_each_text_is_read_once(spark, texts, tmp_path, monkeypatch):
    """Counting, training and scoring start from the same written ids."""
    plain = lm._block_words

    def counted(column, *rest):
        with (tmp_path / "said").open("a") as f:
            f.write("x" * len(column))
        return plain(column, *rest)

    monkeypatch.setattr(lm, "_block_words", counted)
    assert lm.language_model_scores(texts, rounds=1).count() == 306
    assert len((tmp_path / "said").read_text()) == 306


@pytest.mark.parametrize("remembered", [None, 2])
@pytest.mark.parametrize("name", [lm.WORD_BPE, "byte_bpe_50k.json"])
def test_ids_by_word_are_those_of_whole_texts(name, remembered):
    enc = subwords.Encoder(lm.tokenizer_path(name), remembered)
    odd = ["The \u00dcn\u00efcode x \u03a3\u0391\u03a3 stra\u00dfe, \u00c9T\u00c9... don't 3.5% (a)  b\u3000c \x0bq\x85z \u0130st \u65e5\u672c\u8a9e \u212a A\u0301 x,y. Z!"]
    for many in ([], [None], ["", None, " \t\n ", "a"], odd * 3, ["x\x1cy Z", "a b"], ["w" * 1000 + " q", None, "A a ,. .a"], ["the end. The", "END the, the."]):
        got = lm._block_words(pa.array(many, pa.string()), [True] * len(many), 3, enc)[0]
        end = enc.tokenizer.get_vocab_size()
        want = [np.array([-1, *np.frombuffer(x, "<i4"), end], np.int32).tobytes() for x in enc._whole([t or "" for t in many])]
        assert got == want


def test_training_scales_down_to_no_texts(spark):
    none = spark.createDataFrame([(1, "x")], "doc_id long, text string").limit(0)
    vocabulary, model = lm.train(none, rounds=1)
    assert np.isfinite(model.flat()).all() and len(vocabulary.classes)
