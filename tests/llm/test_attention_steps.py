from __future__ import annotations

import types

import numpy as np
import pytest

from carryall.llm import attention_lm as lm


def given(scale: float = 0.3):
    rng = np.random.default_rng(4)
    model = lm.AttentionModel(rng.random((lm.CLASSES + 1, lm.CLASSES)))
    for k, w in model.w.items():
        model.w[k] = (rng.normal(size=w.shape) * scale).astype(np.float32)
    x, y = (rng.integers(0, lm.CLASSES, (40, lm.WINDOW)).astype(np.int32) for _ in range(2))
    return model, x, y, rng.random(x.shape) < 0.8


@pytest.mark.parametrize("scale", [0.3, 2])
def test_gradients_are_the_slopes_of_the_loss(scale):
    """The larger weights give attention scores beyond their bound, and logits that need a shift."""
    model, x, y, on = given(scale)
    flat, grads = model.flat().astype(np.float64), model.gradients(x, y, on)

    def loss(weights):
        model.load(weights)
        return -model.log_probabilities(x, y, on).sum(dtype=np.float64) / on.sum()

    rng = np.random.default_rng(6)
    at = 0
    for k, shape in model.SHAPES.items():
        g = grads[k].reshape(-1).astype(np.float64)
        assert grads[k].shape == shape and np.isfinite(g).all()
        if scale < 1:
            step = np.zeros_like(flat)
            step[at : at + g.size] = g / np.linalg.norm(g) + rng.normal(size=g.size) / g.size
            near = (loss(flat + 1e-2 * step) - loss(flat - 1e-2 * step)) / 2e-2
            assert near == pytest.approx(g @ step[at : at + g.size], rel=0.02, abs=2e-4)
        at += g.size


@pytest.mark.parametrize("step", ["gradients", "log_probabilities"])
def test_members_of_all_groups_go_through_one_exponential(step, monkeypatch):
    model, x, y, on = given()
    calls = []
    counting = types.SimpleNamespace(**{k: getattr(np, k) for k in dir(np)})
    counting.exp = lambda *a, **k: calls.append(1) or np.exp(*a, **k)
    monkeypatch.setattr(lm, "np", counting)
    getattr(model, step)(x, y, on)
    # Of the attention, the groups and the members.
    assert len(calls) == 3


def test_one_pass_of_training_leaves_a_model_that_can_be_kept():
    model, x, y, on = given()
    before = model.log_probabilities(x, y, on).sum()
    for r in range(5):
        model.train(x, y, on, 0.01, r)
    other = lm.AttentionModel(np.zeros((lm.CLASSES + 1, lm.CLASSES)))
    other.follow_group, other.follow_member = model.follow_group, model.follow_member
    other.load(model.flat())
    assert other.log_probabilities(x, y, on).sum() > before
