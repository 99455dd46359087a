"""Columns named like a step's own, repeated and null ids, and sentences of many scripts."""

import random

import pytest
from pyspark.sql import functions as F

from tickweave.llm import exact_dedup, minhash, queries, sentence_spans, shard_tree

SF = "/root/testdata/sf0.01"
AWKWARD = ["__id", "__stay", "__key", "__spans", "__first", "__bucket", "__n", "__text", "__uid", "__len", "__pre", "__row",
           "id", "uid", "row", "len", "key", "of", "size", "salt", "a.b", "SHARD_"]


def awkward(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", "text", *[F.concat(F.lit(c), F.col("text")).alias(c) for c in AWKWARD])


ROWS = [(1, "one two three four five six seven eight"), (2, "one two three four five six seven eight"), (3, None), (None, ""),
        (None, "nine ten eleven twelve thirteen"), (None, "x y z"), (4, "ONE two three four five six seven eight")]


def keeps_columns(out, df):
    assert out.columns == df.columns
    for r in out.select("text", *[f"`{c}`" for c in AWKWARD]).collect():
        assert all(r[i + 1] == (None if r[0] is None else c + r[0]) for i, c in enumerate(AWKWARD))


def test_names(spark):
    df = awkward(spark, ROWS)
    kept = minhash.dedup(df, width=3)
    keeps_columns(kept, df)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None", "None", "None"]
    kept = exact_dedup.dedup(df)
    keeps_columns(kept, df)
    assert kept.count() == len(ROWS) - 2  # one copy of a text, and the null text beside the empty one
    out = exact_dedup.refine(df, exact_dedup.normalised("text"))
    assert out.columns == [*df.columns, "keep_id", "group_size", "kept"]
    keeps_columns(sentence_spans.remove(df), df)
    placed = shard_tree.assign(df, shard_tree.balanced_tree(3))
    assert placed.columns == [*df.columns, "shard", "grown_shard", "slot"]
    keeps_columns(placed.drop("shard", "grown_shard", "slot"), df)


def test_a_third_of_the_ids_null_or_repeated(spark):
    r = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(90):
        text = [r.choice(words) for _ in range(60)]
        near = [*text[:-2], "changed", "end"]
        ids = [(None, None), (7, 7), (1000 + 2 * i, 1001 + 2 * i)][i % 3]
        rows += [(ids[0], " ".join(text)), (ids[1], " ".join(near))]
    rows += [(None, "same words here again and again")] * 30  # null id and text repeat
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, width=3, threshold_pct=85, carry={"t": F.col("text")}).collect()
    assert len(got) == len(rows)
    groups = {}
    for g in got:
        groups.setdefault(g["t"].replace(" changed end", "").rsplit(" ", 2)[0] if "changed" not in g["t"]
                          else g["t"].replace(" changed end", ""), []).append(g)
    for g in groups.values():  # both texts of a pair are linked: one leads
        assert len({x["t"] for x in g if x["leader"]}) == 1
        assert len({x["component_id"] for x in g}) == 1


def test_slots_of_one_key_are_dealt_over_buckets(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("size"))
    out = shard_tree.assign(rows, shard_tree.balanced_tree(4))
    got = [r["slot"] for r in out.collect()]
    assert sorted(got) == list(range(3000)) and out.select("shard").distinct().count() == 1
    plan = shard_tree.slots(rows.withColumn("shard", F.lit(1)))._jdf.queryExecution().analyzed().toString()
    assert "size" in plan.split("__bucket")[0]  # the bucket is by the row's content


def test_exact_dedup_deals_a_hot_length_and_prefix(spark):
    rows = spark.range(4000).select("id", F.concat(F.lit("p" * 300), F.lpad(F.col("id").cast("string"), 6, "0")).alias("text"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = exact_dedup.refine(rows, F.col("text"), id_col="id")
        assert out.filter("kept and group_size = 1").count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SENTENCES = {
    "zh": "这个项目的目标是建立一个可靠的系统。我们需要更多的时间来完成测试工作。请在星期五之前把报告发给大家！",
    "ja": "この文章は重複を見つけるための例です。文はここで終わります。次の文も続きます。",
    "hi": "यह एक लंबा उदाहरण वाक्य है जो दोहराया जाता है। दूसरा वाक्य भी यहाँ पर है। तीसरा वाक्य अंत में आता है।",
    "ar": "هذه جملة طويلة مكررة في النص؟ الجملة الثانية هنا أيضا؟ والجملة الثالثة في النهاية كلها؟",
    "th": "นี่คือประโยคตัวอย่างที่ยาวพอ\nประโยคที่สองอยู่ที่นี่\nประโยคที่สามอยู่ท้ายสุด\n",
    "en": "The first sentence is quoted here. A second one follows it at once. And then a third ends the passage.",
}


@pytest.mark.parametrize("lang", SENTENCES)
def test_passages_of_many_scripts_are_found(spark, lang):
    passage = SENTENCES[lang]
    docs = spark.createDataFrame([(1, f"Alpha beta gamma.\n{passage}\nDelta."), (2, f"Other words here.\n{passage}\nEnd."),
                                  (3, "Nothing that repeats at all.")], "doc_id long, text string")
    got = sentence_spans.repeated_spans(docs).collect()
    assert [g["doc_id"] for g in got] == [2]
    text = f"Other words here.\n{passage}\nEnd."
    assert passage.strip() in text[got[0]["start"]:got[0]["end"] + 1]


@pytest.mark.parametrize("change", [
    lambda s: s.replace("The first sentence is quoted here.", "“The first sentence is quoted here.”"),
    lambda s: s.replace("The first sentence is quoted here.", '"The first sentence is quoted here."'),
    lambda s: s.replace(" follows it", " - follows, it"), lambda s: s.replace(".", "!"), str.upper])
def test_marks_and_quotes_do_not_matter(spark, change):
    docs = spark.createDataFrame([(1, SENTENCES["en"]), (2, change(SENTENCES["en"]))], "doc_id long, text string")
    got = sentence_spans.repeated_spans(docs).collect()
    assert [(g["doc_id"], g["first_sentence"], g["last_sentence"]) for g in got] == [(2, 0, 2)]


def test_capitals_that_become_two_characters_keep_places():
    text = "İstanbul ist groß. «Ça va?» dit-il. The END_of it!"
    low = sentence_spans.spaced(text)
    assert len(low) == len(text) and low.split() == ["İstanbul", "ist", "groß", "ça", "va", "dit", "il", "the", "end", "of", "it"]
    assert [text[a:b].strip() for a, b, _, _ in sentence_spans.sentences(text)] == [
        "İstanbul ist groß.", "«Ça va?»", "dit-il.", "The END_of it!"]
