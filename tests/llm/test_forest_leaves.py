"""Leaves of the vector forest that hold too many vectors are split again."""

from __future__ import annotations

import numpy as np
import pytest

from carryall.llm import embeddings


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(2000, 32))
    vectors = base[np.arange(4000) // 2] + rng.normal(size=(4000, 32)) * 0.08
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    return vectors, near.sum(1)


def rows_of(spark, vectors):
    return spark.createDataFrame([(k, v.tolist(), "x") for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label string")


def test_sample_far_below_the_table(spark, planted, monkeypatch):
    vectors, want = planted
    sizes = []

    def spy(df, most):
        out = larger(df, most)
        sizes.append(df.groupBy(*embeddings._WHERE).count().agg({"count": "max"}).first()[0])
        return out

    larger = embeddings._larger
    monkeypatch.setattr(embeddings, "_larger", spy)
    got = embeddings.near_vectors(rows_of(spark, vectors), sample=100, full=300)
    found = {r.vec_id: r.n_links for r in got.collect()}
    assert len(found) == len(vectors)
    # The sample's leaves were over-full; those that are compared are not.
    assert sizes[0] > 300 >= sizes[-1]
    assert all(found[k] <= want[k] for k in found)
    assert sum(found.values()) >= 0.95 * want.sum() > 1000


def test_vectors_too_near_to_be_split_stay_whole(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = np.ones((400, 16)) + rng.normal(size=(400, 16)) * 0.001
    monkeypatch.setattr(embeddings, "PART", 90)
    got = embeddings.near_vectors(rows_of(spark, vectors), full=100).collect()
    assert [(r.n_links, r.component_id) for r in got] == [(399, 0)] * 400
