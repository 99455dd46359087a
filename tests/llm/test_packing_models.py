"""Packing, toxicity, mixing and the pipeline: round trips, optimality, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickweave.llm import best_fit, mixing, queries, tokens, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 20_000 + "x", "<|endoftext|> it's <|endoftext|>", "naïve\u00a0\u2028 x\r\n\t", "ab" * 9_000])
def test_ids_of_odd_texts(reference, text):
    assert tokens.encoder(tokens.vocabulary_path())(text) == reference(text)


def check_packing(out, capacity=1024):
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_round_trip(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).unionByName(spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9001, "again", "en", "s", 5),
         (None, "word " * 5000, "en", "s", 0), (9003, "a <|endoftext|> b", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars int"))
    packed = best_fit.pack(docs, with_ids=True)
    rows = packed.collect()
    check_packing(rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    texts = {}
    for r in rows:
        texts.setdefault(r["id"], []).append(r)
    for d in docs.collect():
        if d["doc_id"] == 9001:
            continue
        got = sorted(texts[d["doc_id"]], key=lambda r: r["piece"])
        ids = [i for r in got for i in r["ids"]]
        assert ids == [*reference(d["text"] or ""), 2]
        assert [r["length"] for r in got[1:]] == [1024] * (len(got) - 1)
        assert [r["start"] for r in got] == [sum(x["length"] for x in got[:k]) for k in range(len(got))]
    whole = {s["sequence_id"]: s["ids"] for s in best_fit.sequences(packed).collect()}
    for r in rows:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


@pytest.mark.parametrize("kind", ["uniform", "small", "equal", "none", "hot"])
def test_close_to_the_least_number_of_sequences(spark, kind):
    r = random.Random(4)
    sizes = {"uniform": [r.randrange(1, 1025) for _ in range(600)], "small": [r.randrange(1, 60) for _ in range(900)],
             "equal": [300] * 400, "none": [], "hot": [513] * 50 + [512] * 200 + [r.randrange(1, 400) for _ in range(100)]}[kind]
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, size int")
    got = {x["uid"]: (x["sequence_id"], x["offset"]) for x in best_fit.place(items).collect()}
    assert set(got) == set(range(len(sizes)))
    used = check_packing([{"sequence_id": s, "offset": o, "length": sizes[u]} for u, (s, o) in got.items()])
    bins = []  # best-fit decreasing, one item at a time
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if b >= s]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - s)
        else:
            bins.append(1024 - s)
    assert used <= 1.02 * len(bins) + 1


def test_matches_across_ranges():
    assert best_fit._across([(0, 0, 3), (1, 1, 1), (2, 3, 0), (3, 5, 0)]) == [
        (0, 2, 1, 0, 1), (1, 0, 2, 0, 1), (0, 1, 2, 1, 2)]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n = got.agg(F.sum("toxic").alias("toxic"), F.sum(F.expr("toxic * predicted")).alias("hit"),
                F.sum("predicted").alias("said")).first()
    assert n["hit"] / n["toxic"] >= 0.9 and n["hit"] / n["said"] >= 0.95


@pytest.mark.parametrize("term", ["muslim", "gitanos"])
def test_swaps_keep_neutral_mentions_clean(spark, term):
    r = random.Random(6)
    filler = [f"word{i}" for i in range(60)]

    def text(*more):
        w = [r.choice(filler) for _ in range(12)] + list(more)
        r.shuffle(w)
        return " ".join(w) + "."

    docs, labels = [], []
    for i in range(600):  # abuse mostly names one group; the group is also named neutrally, less often
        toxic = i % 3 == 0
        named = r.random() < (0.9 if toxic else 0.05)
        docs.append((i, text(*(["vermin"] if toxic and r.random() < 0.6 else []), *([term] if named else []))))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = spark.createDataFrame([(k, text(term)) for k in range(60)], "doc_id long, text string")
    share = {}
    for penalty in (0.0, 5.0):
        model = toxicity.train(d, lab, swap_penalty=penalty)
        share[penalty] = toxicity.score(neutral, model).filter("score >= 0.5").count() / 60
        assert model.swaps > 100  # the penalty has sentences to act on
    assert share[0.0] > 0.5 and share[5.0] < 0.2, share


def test_every_telling_word_has_a_weight(spark):
    """7000 words tell the classes apart equally well; texts of any 20 of them are told apart."""
    r = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = r.sample([x + y + z for x in letters for y in letters for z in letters], 7000)
    docs, tests = [], []
    for toxic, words in enumerate((vocabulary[:3500], vocabulary[3500:])):
        texts = [set() for _ in range(600)]
        for w in words:
            for t in r.sample(texts, 20):
                t.add(w)
        docs += [(len(docs) + i, " ".join(sorted(t)), toxic) for i, t in enumerate(texts)]
        words = sorted(words)
        tests += [(len(tests) + i // 20, " ".join(words[i:i + 20]), toxic) for i in range(0, 3500, 20)]
    d = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.train(d, d, swap_penalty=0.0)
    assert set(vocabulary) <= set(model.weights)
    got = toxicity.score(spark.createDataFrame(tests, "doc_id long, text string, toxic int"), model)
    assert got.filter("score >= 0.5 and toxic = 0 or score <= 0.5 and toxic = 1").count() == 0


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (1, "x " * 50_000, "a")],
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 0)], "doc_id long, toxic int")
    for labels in (none, odd):
        got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert len(got) == 4 and all(0 <= g["score"] <= 1 for g in got)
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0


def test_rates_reach_their_targets(spark):
    r = random.Random(8)
    rows = []
    for _ in range(800):
        p = np.array([r.random() ** 3, r.random(), r.random() ** 2])
        rows.append((r.randrange(1, 900), (p / p.sum()).tolist()))
    df = spark.createDataFrame(rows, "tokens long, p array<double>")
    for weights, total in (([0.2, 0.5, 0.3], None), ([0.5, 0.3, 0.2], 150_000.0), ([0.05, 0.9, 0.05], 100_000.0)):
        steps, info = mixing.fit_rates(df, weights, total)
        got = df.withColumn("r", mixing.rate("p", steps)).collect()
        assert min(g["r"] for g in got) >= 0
        sums = [sum(g["tokens"] * g["p"][i] * g["r"] for g in got) for i in range(3)]
        assert np.allclose(sums, info["after"])
        if total != 100_000.0:  # the last asks for more of one domain than posteriors can separate
            assert np.abs(np.array(sums) / sum(sums) - weights).max() < 1e-3
        else:
            start = np.array(info["before"]) / sum(info["before"])
            assert np.abs(np.array(sums) / sum(sums) - weights).sum() < np.abs(start - weights).sum()


@pytest.mark.parametrize("a, b, reached", [(40, 1, True), (4, 36, True), (2, 18, True), (2, 60, False), (400, 7600, False)])
def test_staying_rates_lose_no_document(spark, a, b, reached):
    """Weak and clean classifiers: no rate under 1, a bounded corpus, shares nearer to their targets."""
    r = random.Random(a * 100 + b)
    clean = (a, b) == (40, 1)  # a tenth of the documents surely of the second domain; else all posteriors alike
    low = [r.betavariate(a, b) if not clean or r.random() < 0.1 else r.betavariate(1, 60) for _ in range(3000)]
    df = spark.createDataFrame([(r.randrange(1, 900), [1 - x, x]) for x in low], "tokens long, p array<double>")
    steps, info = mixing.fit_staying(df, [0.86, 0.14])
    got = df.withColumn("r", mixing.rate("p", steps, 1.0)).collect()
    assert min(g["r"] for g in got) >= 1
    sums = np.array([sum(g["tokens"] * g["p"][i] * g["r"] for g in got) for i in range(2)])
    start = np.array(info["before"]) / sum(info["before"])
    assert np.allclose(sums, info["after"])
    assert sums.sum() <= 2 * max(info["before"][0] / 0.86, info["before"][1] / 0.14) * 1.001
    gap = abs(sums[1] / sums.sum() - 0.14)
    assert abs(info["missed"] - gap) < 1e-9 and (gap < 1e-3 if reached else gap < abs(start[1] - 0.14))


def test_mixing_with_a_weak_classifier_keeps_all(spark):
    """Labels that the texts hardly tell: no document is lost and none repeated without bound."""
    r = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(1500):
        low = r.random() < 0.1
        rows.append((i, " ".join(r.choice(words[:14] if low and r.random() < 0.25 else words) for _ in range(20)), int(not low)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    domain = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    for targets in ({"good": 0.86, "low": 0.14}, {"good": 0.3, "low": 0.7}):
        out = mixing.mix(docs, docs, targets, domain, all_stay=True).groupBy("doc_id").count().collect()
        assert {x["doc_id"] for x in out} == set(range(1500))
        assert sum(x["count"] for x in out) <= 2 * 1500 * max(0.9 / targets["good"], 0.2 / targets["low"]) * 1.2


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (1, "x " * 5_000, "a")],
                                 "doc_id long, text string, rate string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, None), (1, 0, 1), (2, None, None), (None, 1, 0)],
                                "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        out, _ = mixing.rates(docs, labels)
        assert out.count() == 4 and out.filter("rate < 0 or copies < 0").count() == 0
    assert mixing.mix(docs, odd).columns == docs.columns
    assert mixing.mix(docs, odd, all_stay=True).select("doc_id", "text").distinct().count() == 4
    assert mixing.mix(docs.limit(0), none, all_stay=True).count() == 0
    assert mixing.mix(docs.limit(0), none).count() == 0


def test_mixed_corpus_has_the_target_shares(spark):
    out = queries.op10_mixing(spark, SF)
    s = out.agg(*[F.sum(F.expr(f"tokens * p_{d} * rate")).alias(d) for d in mixing.TARGETS]).first()
    for d, w in mixing.TARGETS.items():
        assert abs(s[d] / sum(s) - w) < 1e-3


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "minhash near-dedup", "mixing", "best-fit packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == docs.columns
        at = spark.createDataFrame(at.collect(), docs.schema)
        seen[name] = at
    texts = [" ".join(r["text"].split()) for r in seen["exact dedup"].collect()]
    assert len(texts) == len(set(texts)) == len({" ".join(r["text"].split()) for r in seen["toxicity"].collect()})
    ids = {r["doc_id"] for r in seen["minhash near-dedup"].collect()}
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for w in [r["text"].lower().split()] for i in range(max(1, len(w) - 4))}
            for r in seen["exact dedup"].collect()}
    for a in sets:  # nothing near is left, and what went has something near
        near = [b for b in sets if b != a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        assert (a in ids and not any(b in ids for b in near)) or near
    assert {r["doc_id"] for r in seen["mixing"].collect()} == ids
    out = corpus_pipeline.run(spark, sf).collect()
    check_packing(out)
    assert {r["doc_id"] for r in out} == ids


def test_stages_on_odd_documents(spark, tmp_dir):
    """Nulls, repeated rows and ids, blank and long texts, clashing names, empty tables."""
    rows = [(1, "a b c d e f g", "s", 1.0, "x"), (1, "a b c d e f g", "s", 1.0, "x"), (None, "a b c d e f g", None, None, "y"),
            (None, None, None, 2.0, None), (2, None, "s", 2.0, "z"), (3, "", "s", 2.0, "z"), (4, " \n ", "s", 3.0, "z"),
            (5, "word " * 30_000, "s", 3.0, "z"), (6, "word " * 30_000 + "!", "s", 3.0, "z"), (None, "other text", "s", 3.0, "q")]
    schema = "doc_id long, text string, source string, rate double, kept string"
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 1), (3, 0, None), (99, 1, 0), (5, 1, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        at, n = docs, []
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, tmp_dir)
            assert at.columns == docs.columns
            got = at.collect()
            at = spark.createDataFrame(got, docs.schema)
            n.append(len(got))
            assert {(r["rate"], r["kept"]) for r in got} <= {(r[3], r[4]) for r in rows}
        packed = corpus_pipeline.STAGES[-1][1](spark, at, tmp_dir).collect()
        check_packing(packed)
        if docs.isEmpty():
            assert n == [0, 0, 0, 0] and not packed
        else:
            assert n[0] == len(rows) and n[1] == 6 and n[2] == 6 and n[3] >= 6
