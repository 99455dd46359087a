"""Scoring texts together against the plain definition of their features."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tickweave.llm import linear

ODD = ["", None, "a", "İstanbul ſ ǅ", "日本 語 “q”¿x? été_1 ²½ Ⅷ \x00\x1c  z", "áb x​y 1,2.3|4", "\n\n a \n a \n", "_ __ ___"]


def plain(model, text):
    """Sum of the weights of the features present, from the feature sets used in training."""
    text, words = linear.read(text)
    shape, names = linear.features(text, words)
    z = [math.fsum([b, *[model.weights[f][c] for f in [*shape, *names] if f in model.weights]]) for c, b in enumerate(model.bias)]
    if len(z) == 1:
        return len(words), [1 / (1 + math.exp(-min(30.0, max(-30.0, z[0]))))]
    e = [math.exp(x - max(z)) for x in z]
    return len(words), [x / sum(e) for x in e]


def some_model(texts, outs, seed=0):
    r = np.random.default_rng(seed)
    names = sorted({f for t in texts for g in linear.features(*linear.read(t)) for f in g})
    names = [n for n in names if r.random() < 0.5]
    return linear.Model(r.normal(size=outs), {n: tuple(r.normal(size=outs)) for n in names})


def check(texts, outs):
    model = some_model(texts, outs)
    for (n, p), (m, q) in zip([plain(model, t) for t in texts], model.scorer()(texts), strict=True):
        assert n == m and max(abs(a - b) for a, b in zip(p, q)) < 1e-9


def test_odd_texts():
    for outs in (1, 3):
        check(ODD, outs)
        check(["word " * 3000 + "Ünders", *ODD], outs)
    assert linear.Model(np.zeros(2)).scorer()(["x", None]) == [(1, [0.5, 0.5]), (0, [0.5, 0.5])]


def test_texts_in_parts_score_the_same(monkeypatch):
    model = some_model(ODD, 2)
    want = model.scorer()(ODD)
    monkeypatch.setattr(linear, "TOGETHER", 5)
    assert model.scorer()(ODD) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aé b\nß.,|1_", max_size=60)), max_size=6))
def test_random_texts(texts):
    check(texts, 2)
    found = linear.Words.of([t or "" for t in texts])
    words = [w for t in texts for w in linear.read(t)[1]]
    assert found.distinct.take(found.word).to_pylist() == words
