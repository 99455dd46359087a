"""Spherical-cap links and license alignment against brute force."""

import random

import numpy as np
import pytest

from tickweave.llm import license_scan, queries, sphere_caps

SF = "/root/testdata/sf0.01"


def brute_links(rows, least):
    ok = []
    for k, (i, label, v) in enumerate(rows):
        if label is None or v is None or not v or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        if np.isfinite(x).all() and np.abs(x).max() > 0:
            x = x / np.abs(x).max()
            ok.append((k, label, x / np.linalg.norm(x)))
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ok)):
        for b in range(a):
            if ok[a][1] == ok[b][1] and len(ok[a][2]) == len(ok[b][2]) and ok[a][2] @ ok[b][2] >= least:
                n[ok[a][0]] += 1
                n[ok[b][0]] += 1
                parent[find(ok[a][0])] = find(ok[b][0])
    low = {}
    for k, (i, _, _) in enumerate(rows):
        c = find(k)
        low[c] = min([x for x in (low.get(c), i) if x is not None], default=None)
    return sorted(repr((rows[k][0], n[k], low[find(k)])) for k in range(len(rows)))


def test_edge_cases(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal((6, 64)).astype(np.float32).tolist()
    rows = [(3, 1, base[0]), (1, 1, base[0]), (2, 2, base[0]), (4, None, base[0]), (5, 1, None), (6, 1, []),
            (7, 1, [0.0] * 64), (8, 1, [float("nan")] + base[0][1:]), (9, 1, [None] + base[0][1:]),
            (10, 1, (np.float32(2.0) * np.array(base[0], np.float32)).tolist()), (11, 1, base[0][:32]), (12, 1, base[1]),
            (None, 1, base[1]), (12, 1, base[1]), (13, 1, [float("inf")] + base[0][1:]), (14, 1, [-0.0] + base[2][1:]),
            (15, 1, [0.0] + base[2][1:])]
    df = spark.createDataFrame([(*x, 5) for x in rows], "vec_id long, label int, embedding array<float>, n_links int")
    got = sphere_caps.near_duplicates(df).collect()
    assert sorted(repr((g["id"], g["n_links"], g["component_id"])) for g in got) == brute_links(rows, 0.93)
    assert sphere_caps.near_duplicates(df.limit(0)).count() == 0


def test_whole_table_against_brute_force(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(x["vec_id"], x["label"], x["embedding"]) for x in t]
    got = queries.op4_sphere_caps(spark, SF).collect()
    assert sorted(repr((g["vec_id"], g["n_links"], g["component_id"])) for g in got) == brute_links(rows, 0.93)


@pytest.mark.parametrize("cosine", [0.931, 0.95, 0.98])
def test_recall_just_above_the_threshold(spark, cosine):
    r = np.random.default_rng(int(cosine * 1000))
    a = r.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.standard_normal((400, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + np.sqrt(1 - cosine ** 2) * b
    rows = [(i, 0, x.tolist()) for i, x in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = sphere_caps.near_duplicates(df).filter("n_links > 0").count()
    assert found / 800 >= 0.99


def lcs(a, b):
    d = [0] * (len(b) + 1)
    for x in a:
        p = 0
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], p + 1 if x == y else max(d[j], d[j - 1])
    return d[-1]


def test_alignment_is_a_common_subsequence_and_longest_without_repeats():
    r = random.Random(2)
    for _ in range(200):
        a = [r.choice("abcdefgh") for _ in range(r.randrange(12))]
        b = [r.choice("abcdefgh") for _ in range(r.randrange(12))]
        got = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in got) and len(got) <= lcs(a, b)
        assert all(x < x2 and y < y2 for (x, y), (x2, y2) in zip(got, got[1:]))
        once = r.sample([f"w{i}" for i in range(30)], 20)
        other = [w for w in r.sample(once, 20) if r.random() < 0.8]
        assert len(license_scan.align(once, other)) == lcs(once, other)


def test_scan(spark):
    mit, apache = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0-line"]
    words = mit.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 9)
    long = "filler words here " * 20_000
    rows = [(1, f"x {mit} y"), (2, edited), (3, f"{long} {apache} {long}"), (4, f"{apache} then {apache}"), (5, None),
            (6, ""), (7, "licensed soup under the version apache of 2 licenses"), (8, "Released under the MIT License."),
            (8, "RELEASED UNDER THE MIT LICENSE."), (9, "İ İ " + apache)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, license int")
    got = license_scan.scan(df).collect()
    by = {}
    for g in got:
        by.setdefault(g["doc_id"], []).append((g["license"], round(g["coverage"], 2)))
    assert by == {1: [("MIT", 1.0)], 2: [("MIT", by[2][0][1])], 3: [("Apache-2.0-line", 1.0)],
                  4: [("Apache-2.0-line", 1.0)] * 2, 8: [("MIT-line", 1.0)] * 2, 9: [("Apache-2.0-line", 1.0)]}
    assert 0.85 < by[2][0][1] < 0.95
    one = next(g for g in got if g["doc_id"] == 3)
    assert rows[2][1][one["start"]:one["end"]] == apache.rstrip(".")
    assert license_scan.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_verbatim_notice_after_template_words(name):
    """A template word at any distance before a notice, or an edited notice, changes nothing about it."""
    t = license_scan.WORD.findall(license_scan.TEMPLATES[name].lower())
    words = sorted(set(t)) if len(t) < 20 else sorted(set(t))[::12]
    for w in words:
        for gap in range(0 if w != t[0] else 1, len(t) * 3 // 2 + 1, 1 if len(t) < 20 else 5):
            text = ["x", w, *["y"] * gap, *t, "z", *["y"] * 5]
            got = license_scan.find(text, t, 0.8, 1.5)
            assert got == [(2 + gap, 1 + gap + len(t), 1.0)], (w, gap)
    if len(t) >= 10:
        edited = [x for i, x in enumerate(t) if i != len(t) // 2]
        got = license_scan.find([*edited, "y", *t], t, 0.8, 1.5)
        assert got == [(0, len(t) - 2, (len(t) - 1) / len(t)), (len(t), 2 * len(t) - 1, 1.0)]


def test_op3_finds_every_license_line(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(d["doc_id"], k) for d in docs for k, t in license_scan.TEMPLATES.items() if t in d["text"]}
    got = {(g["doc_id"], g["license"]) for g in queries.op3_license_scan(spark, SF).collect()}
    assert want and want <= got
