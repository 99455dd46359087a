"""Accumulator-limited ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from tickweave.llm import queries, ranked_search

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [w.translate(FOLD) for w in TERM.findall(text or "")]


def brute(docs, items, k=50):
    """Every document scored for every item, straight from the contract."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(n for _, _, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in items:
        ranked = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w in set(terms_of(text)) if w in c)
            if s > 0:
                ranked.append((-s, i is None, i))
        ranked.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(ranked[:k])]
    return out


def found(df):
    return sorted(map(tuple, df.select("item", "rank", "id", "score").collect()), key=str)


def corpus(seed, n=1500):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(r.choices(words, weight, k=r.choice([1, 5, 40, 200])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(n // 3)]  # a hot group of copies: ties
    items = [(i, " ".join({*r.choices(words, k=6), *words[:r.randrange(1, 9)]})) for i in range(25)]
    items += [(100, docs[3][1]), (101, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("seed, k, growth", [(1, 5, 2.0), (2, 50, 1.1), (3, 3, 8.0), (4, 10_000, 2.0)])
def test_against_brute_force(spark, seed, k, growth):
    docs, items = corpus(seed)
    got = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                               spark.createDataFrame(items, "item_id long, text string"), k=k, growth=growth)
    assert found(got) == sorted(brute(docs, items, k), key=str)


def test_items_stop_creating_accumulators_and_lose_nothing(spark, monkeypatch):
    docs, items = corpus(5, 3000)
    seen = {}
    finish = ranked_search._finish

    def spy(rows, its, *a):
        seen.update(its)
        return finish(rows, its, *a)

    monkeypatch.setattr(ranked_search, "_finish", spy)
    got = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string"), k=5, growth=1.2)
    assert found(got) == sorted(brute(docs, items, 5), key=str)
    assert sum(x.stop < len(x.terms) for x in seen.values()) > 10  # the limit is at work
    assert all(x.rest[x.stop] < x.kth for x in seen.values() if x.stop < len(x.terms))


def test_blocks_of_items_give_the_same(spark):
    docs, items = corpus(6)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked_search.search(d, i, k=7, block_bytes=2000)) == sorted(brute(docs, items, 7), key=str)


def test_odd_rows_and_names(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (4, "Ünder ÄÖ été x\x00y"), (5, "under äö ÉTÉ X y"), (None, "alpha beta"),
            (6, "alpha beta"), (6, "alpha beta"), (7, "alpha " * 50_000 + "omega"), (8, "日本 語 alpha beta")]
    items = [(1, "alpha OMEGA"), (1, "ünder été"), (None, "beta y"), (2, None), (3, ""), (4, "unseen words"), (5, "日本")]
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, n int, score int, item int")
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, id int")
    assert found(ranked_search.search(d, q)) == sorted(brute(docs, items), key=str)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found(ranked_search.search(none, q)) == []
    assert found(ranked_search.search(d, q.limit(0))) == []


def test_long_texts_are_read_in_slices(monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE", 10)
    text = "One, two-three  FOUR five_six seven\n" * 30 + "x" * 40 + " end"
    assert [w.decode() for ws in ranked_search.terms(text.encode()) for w in ws] == terms_of(text)


def test_query_against_brute_force(spark):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(
        "doc_id" if t == "documents" else "item_id", "text").collect()]
    got = queries.queries()["op12_ranked_terms"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute(read("documents"), read("benchmark")))
