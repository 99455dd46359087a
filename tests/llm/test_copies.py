"""Exact dedup, MinHash near-duplicates, components and sentence spans against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickweave.llm import exact_dedup, minhash, sentence_spans
from tickweave.llm.components import connected

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union(parent, a, b):
    a, b = find(parent, a), find(parent, b)
    parent[max(a, b)] = min(a, b)


def test_exact_dedup_edge_cases(spark):
    long = "word " * 60_000
    rows = [(5, "a  b", "k"), (2, "a\tb", "k"), (9, "a b", "k"), (None, "a b", "k"), (1, None, "k"), (4, "", "k"),
            (3, " ", "k"), (8, long + "x", "k"), (7, long + "y", "k"), (6, long + "x", "k"), (11, "p" * 300 + "1", "k"),
            (12, "p" * 300 + "2", "k"), (13, "same", "k"), (13, "same", "k"), (None, "null ids", "k"),
            (None, "null ids", "k"), (14, "a\u00a0b", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = exact_dedup.refine(df, exact_dedup.normalised("text")).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(BLANK.sub(" ", t or ""), []).append(i)
    for r in got:
        mine = groups[BLANK.sub(" ", r["text"] or "")]
        assert r["group_size"] == len(mine)
        assert r["keep_id"] == min((i for i in mine if i is not None), default=None)
    kept = [(r["doc_id"], BLANK.sub(" ", r["text"] or "")) for r in got if r["kept"]]
    assert sorted(map(repr, kept)) == sorted(
        repr((min((i for i in v if i is not None), default=None), k)) for k, v in groups.items())
    assert exact_dedup.dedup(df).columns == df.columns
    assert exact_dedup.dedup(df.limit(0)).count() == 0


def test_components_of_random_graphs(spark):
    r = random.Random(3)
    for nodes, links in ((40, 30), (200, 150), (60, 200)):
        edges = [(r.randrange(nodes), r.randrange(nodes)) for _ in range(links)]
        edges += [(1000 + i, 1001 + i) for i in range(30)]  # a chain
        edges += [(2000, 2001 + i) for i in range(50)] + [(None, 5), (7, None)]  # a hub, null ends
        parent = {n: n for e in edges for n in e if n is not None}
        for a, b in edges:
            if a is not None and b is not None:
                union(parent, a, b)
        got = {x["node"]: x["component"] for x in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
        assert all(got.get(n, n) == find(parent, n) for n in parent)
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text, width):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def check_minhash(spark, rows, width, pct):
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = minhash.near_duplicates(df, width=width, threshold_pct=pct, carry={"text": F.col("text")}).collect()
    assert len(got) == len(rows)
    sets = [(i, shingles(t, width)) for i, t, _ in rows]
    parent = {k: k for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= pct * len(x | y):
                union(parent, a, b)
    low = {}
    for k, (i, _) in enumerate(sets):
        c = find(parent, k)
        low[c] = min([j for j in (low.get(c), i) if j is not None], default=None)
    want = sorted(repr((i, len(s), low[find(parent, k)])) for k, (i, s) in enumerate(sets))
    assert sorted(repr((r["id"], r["n"], r["component_id"])) for r in got) == want
    return df, got


@pytest.mark.parametrize("width,pct", [(3, 85), (5, 80)])
def test_minhash_against_brute_force(spark, width, pct):
    r = random.Random(width)
    vocab = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(25):
        base = [r.choice(vocab) for _ in range(r.choice([4, 30, 120, 400]))]
        for _ in range(r.choice([1, 2, 6, 12])):
            words = list(base)
            for _ in range(r.randrange(0, 1 + len(words) // 40)):
                words[r.randrange(len(words))] = r.choice(vocab)
            rows.append((i * 7 % 1009, (" " if i % 2 else "\n").join(words).upper() if i % 3 else " ".join(words), "z"))
            i += 1
    rows += [(None, None, "z"), (2001, "", "z"), (2002, " \n", "z"), (2003, "One two", "z"), (2004, "one\ttwo", "z"),
             (2005, "É é", "z"), (2006, "é é", "z"), (None, "one two", "z"), (2003, "other text here now", "z"),
             (2007, "x " * 30_000 + "y", "z")]
    df, got = check_minhash(spark, rows, width, pct)
    kept = minhash.dedup(df, width=width, threshold_pct=pct)
    assert kept.columns == df.columns
    assert sorted(repr(x["doc_id"]) for x in kept.collect()) == sorted(
        repr(x["id"]) for x in got if x["leader"] and x["id"] == x["component_id"])


def test_minhash_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0


def test_runs_cover_forwards_and_backwards():
    r = random.Random(5)
    for _ in range(200):
        words = [r.choice([1, 2, 5, 30]) for _ in range(r.randrange(0, 15))]
        want = set()
        for a in range(len(words)):
            fits = [b for b in range(a, len(words)) if b - a >= 2 and sum(words[a:b + 1]) >= 12]
            if fits:
                want.add((a, fits[0]))
        for b in range(len(words)):
            fits = [a for a in range(b + 1) if b - a >= 2 and sum(words[a:b + 1]) >= 12]
            if fits:
                want.add((fits[-1], b))
        assert sentence_spans.runs(words, 3, 12) == sorted(want)


def brute_spans(rows, run=3, least=12):
    seen, out = {}, {}
    for row, (i, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        s = sentence_spans.sentences(text)
        for a, b in sentence_spans.runs([x[2] for x in s], run, least):
            key = tuple(x[3] for x in s[a:b + 1])
            if seen.setdefault(key, (row, a)) != (row, a):
                out.setdefault(row, set()).update(range(a, b + 1))
    return out


def test_spans_against_brute_force(spark):
    r = random.Random(9)
    vocab = [f"v{i}" for i in range(400)]

    def prose(n):
        return " ".join(" ".join(r.choice(vocab) for _ in range(r.randrange(1, 25))).capitalize() + r.choice([".", "!", ".\n"])
                        for _ in range(n))

    passages = [prose(8) for _ in range(4)]
    rows = [(i, prose(r.randrange(0, 10)) + " " + (r.choice(passages) if i % 2 else "") + " " + prose(4)) for i in range(60)]
    rows += [(100, passages[0] + " " + passages[0]), (101, None), (102, ""), (None, passages[1]), (5, passages[2]),
             (103, passages[3]), (104, "One. Two. Three."), (105, "One. Two. Three.")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, row int")
    got = sentence_spans.repeated_spans(df.select("doc_id", "text").coalesce(1)).collect()
    want = brute_spans(rows)
    mine = {}
    for g in got:
        mine.setdefault(repr(g["doc_id"]), []).append((g["first_sentence"], g["last_sentence"]))
    expect = {}
    for row, at in want.items():
        runs, at = [], sorted(at)
        for x in at:
            if runs and x <= runs[-1][1] + 1:
                runs[-1][1] = x
            else:
                runs.append([x, x])
        expect.setdefault(repr(rows[row][0]), []).extend(map(tuple, runs))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in expect.items()}
    cleaned = sentence_spans.remove(df)
    assert cleaned.columns == df.columns and cleaned.count() == len(rows)
    texts = {x["doc_id"]: x["text"] for x in cleaned.collect()}
    assert texts[104] == texts[105] == "One. Two. Three." and texts[101] is None
    assert sum(passages[3][:40] in (t or "") for t in texts.values()) == 1
    assert sentence_spans.repeated_spans(df.limit(0)).count() == 0
