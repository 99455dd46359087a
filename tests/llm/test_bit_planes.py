"""Bit-plane clustering against plain integer arithmetic and a brute-force Lloyd loop."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickweave.llm import bit_planes, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int"


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 28), st.integers(0, 2 ** 31))
def test_dots_and_sums_are_exact(planes, seed):
    r = np.random.default_rng(seed)
    low, high = -(1 << planes - 1), (1 << planes - 1) - 1
    x = r.integers(low, high, (9, 64), endpoint=True)
    x[0], x[1] = low, high
    words = bit_planes.pack(x, planes)
    assert words.shape == (9, planes) and words.dtype == np.uint64
    assert (bit_planes.unpacked_sums(words) == x.sum(axis=0)).all()
    for i in range(9):
        assert (bit_planes.dots(words, words[i]) == x @ x[i]).all()


def brute(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(e)) for e in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(e is not None and math.isfinite(e) for e in v)]
    order = sorted((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (_, j) in zip(kept, got) if j == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    inertia = [sum(d for d, j in got if j == c) for c in range(len(cents))]
    return sorted(((i, j, d, inertia[j], sum(inertia), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, got)), key=str), cents


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = [tuple(r) for r in queries.queries()["op11_bit_planes"](spark, SF).collect()]
    assert sorted(got, key=str) == brute(rows)[0]


def odd_rows():
    r = np.random.default_rng(5)
    flat = [(i, r.normal(size=64).tolist()) for i in range(40)]
    flat += [(100 + i, [0.5] * 64) for i in range(6)]  # copies: ties, clusters that stay empty
    return flat + [
        (7, flat[7][1]), (None, [1.0] * 64), (None, [-2.5] * 64), (201, None), (202, []), (203, [1.0] * 63),
        (204, [1.0] * 65), (205, [None, *[1.0] * 63]), (206, [math.nan, *[1.0] * 63]), (207, [math.inf, *[1.0] * 63]),
        (208, [-1e-9] * 64), (209, [30_000.25] * 64)]


def test_odd_vectors(spark):
    rows = odd_rows()
    out, cents = bit_planes.cluster(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumnRenamed(
        "label", "planes").withColumnRenamed("vec_id", "norm"), id_col="norm")
    want, want_cents = brute(rows)
    assert cents.tolist() == want_cents
    assert sorted((tuple(r) for r in out.collect()), key=str) == [w[:5] for w in want]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = odd_rows()[:n]
    out, cents = bit_planes.cluster(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA))
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia"] and len(cents) == n
    assert sorted((tuple(r) for r in out.collect()), key=str) == [w[:5] for w in brute(rows)[0]]


def test_more_partitions_than_rows_give_the_same(spark):
    rows = spark.createDataFrame([(i, v, 1) for i, v in odd_rows()], SCHEMA)
    one, a = bit_planes.cluster(rows.coalesce(1), k=5, rounds=3)
    many, b = bit_planes.cluster(rows.repartition(90), k=5, rounds=3)
    assert (a == b).all() and sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_components_too_large_for_exact_distances(spark):
    with pytest.raises(ValueError, match="64 bits"):
        bit_planes.cluster(spark.createDataFrame([(1, [1e9] * 64, 1)], SCHEMA))
