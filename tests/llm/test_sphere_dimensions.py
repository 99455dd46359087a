"""Spherical-cap links at other dimensions than the query's."""

import numpy as np
import pytest

from tickweave.llm import sphere_caps


@pytest.mark.parametrize("dim", [1, 2, 8, 16, 32, 47, 48, 384])
def test_recall_at_every_dimension(spark, dim):
    rows, pairs = [], 60
    for label, cosine in enumerate((0.931, 0.95, 0.98)):
        r = np.random.default_rng([dim, label])
        a = r.standard_normal((pairs, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        if dim == 1:
            b = 2 * a
        else:
            b = r.standard_normal((pairs, dim))
            b -= (a * b).sum(1, keepdims=True) * a
            b /= np.linalg.norm(b, axis=1, keepdims=True)
            b = cosine * a + np.sqrt(1 - cosine ** 2) * b
        rows += [(len(rows) + i, label, x.tolist()) for i, x in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {g["id"]: g["n_links"] for g in sphere_caps.near_duplicates(df).collect()}
    x = np.array([v for _, _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([k for _, k, _ in rows])
    near = (x @ x.T >= 0.93) & (same[:, None] == same[None, :])
    want = near.sum(1) - 1
    found = sum(got[i] for i in range(len(rows))) / want.sum()
    assert found == 1 if dim < 48 else 0.99 <= found <= 1
