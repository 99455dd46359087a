"""Sharding by hash tree and URL rules: laws, brute force, edge cases."""

import math
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from tickweave.llm import queries, shard_tree, url_rules
from tickweave.llm.shard_tree import Node, assign, balanced_tree, grow, place

SF = "/root/testdata/sf0.001"


def placed(spark, tree, n=4000):
    return {r["id"]: r["s"] for r in spark.range(n).select("id", place("id", tree).alias("s")).collect()}


def test_shares_follow_weights(spark):
    tree = Node("root", (Node("a", (Node("a1", (Node("s0", shard=0, leaf_weight=3.0), Node("s1", shard=1))),)),
                         Node("b", (Node("b1", (Node("s2", shard=2),)),))))
    n = Counter(placed(spark, tree, 20000).values())
    assert [round(n[i] / 20000, 1) for i in range(3)] == [0.6, 0.2, 0.2]


def test_growth_moves_rows_only_into_the_new_shard(spark):
    for shards in (1, 3, 16):
        tree = balanced_tree(shards)
        old, new = placed(spark, tree), placed(spark, grow(tree))
        moved = {k for k in old if old[k] != new[k]}
        assert {new[k] for k in moved} == {shards}
        assert abs(len(moved) / len(old) - 1 / (shards + 1)) < 0.05


def test_a_weight_change_stays_in_its_subtrees(spark):
    def tree(w):
        return Node("root", tuple(Node(f"g{g}", tuple(Node(f"g{g}r{r}", tuple(
            Node(f"s{g}{r}{s}", shard=g * 4 + r * 2 + s, leaf_weight=w if (g, r, s) == (0, 0, 0) else 1.0)
            for s in range(2))) for r in range(2))) for g in range(3)))
    old, new = placed(spark, tree(1.0)), placed(spark, tree(2.0))
    for k in old:
        if old[k] != new[k]:  # every move goes into region 0, whose weight grew; none between regions 1 and 2
            assert new[k] < 4
            if old[k] < 4 and old[k] // 2 == new[k] // 2:
                assert new[k] == 0  # within rack 0 rows move to the heavier shard only


def test_slots_edge_cases(spark):
    rows = [(i % 7 if i % 5 else None, "x" * i, 9) for i in range(60)] + [(3, "same", 9)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = assign(df, balanced_tree(4), grow(balanced_tree(4))).collect()
    assert len(out) == 65
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    where = {}
    for r in out:
        assert where.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
    assert assign(df.limit(0), balanced_tree(4)).count() == 0


def test_op1_contract(spark):
    out = queries.op1_shard_tree(spark, SF).collect()
    assert len(out) == 200 and {r["law"] for r in out} == {"key"}
    assert all(0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16) for r in out)


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block")]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(r), r, v) for r, v in rules for h, p in [r.split("/", 1)]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def test_judge_against_brute_force(spark):
    urls = ["http://example.org/en/12", "https://a.example.org/es/", "x://b.notexample.org/es/x", "http://com/fr/",
            "http://EXAMPLE.com/de/1?x=/fr/", "http://example.com/DE/1", "http://example.org", "http://example.org?q",
            "no scheme/en/1", None, "", "://org/", "http://x.org/a#b", "http://é.Org/en/1", "http://h.com/de",
            "http://a.com/de/\nx", "http://org.com/en/1", "http://www.example.org/en/1/../es/"] * 2
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = url_rules.judge(df, url_rules.rules_frame(spark, RULES)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], RULES), r
    assert url_rules.judge(df.limit(0), url_rules.rules_frame(spark, RULES)).count() == 0
    assert {r["verdict"] for r in url_rules.judge(df, url_rules.rules_frame(spark, [])).collect()} == {"allow"}


def test_rules_are_fetched_by_their_rarest_complete_token(spark):
    assert url_rules.compile_rule("example.org/en/1")[1] == ["en", "example", "org"]
    assert url_rules.compile_rule("||spam*")[1] == [] and url_rules.compile_rule("||spam.*")[1] == ["spam"]
    words = spark.createDataFrame([(w,) for w in ["org"] * 9 + ["example"] * 5 + ["en"] * 7], "token string")
    index = url_rules.index_rules(url_rules.rules_frame(spark, [("example.org/en/1", "block"), ("*bad*", "block")]),
                                  words).collect()
    assert {r["rule"]: r["token"] for r in index} == {"example.org/en/1": "example", "*bad*": ""}


def test_thousands_of_rules_run_few_expressions(spark):
    """With the index taken out, every url would run every rule."""
    rules = [(f"h{i}.site{i % 50}.com/p{i % 7}/", ("allow", "block")[i % 2]) for i in range(4000)]
    urls = [f"http://www.h{i * 7 % 5000}.site{i * 7 % 5000 % 50}.com/p{i % 7}/x{i}" for i in range(600)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = url_rules.rules_frame(spark, rules)
    got = url_rules.judge(df, frame).collect()
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], rules), r
    assert sum(r["rule"] is not None for r in got) > 50
    words = df.select(F.explode(url_rules.tokens_of(url_rules.host_of("url"), url_rules.path_of("url"))).alias("token"))
    runs = words.join(url_rules.index_rules(frame, words), "token").count()
    assert runs <= 2 * len(urls)  # of 2.4 million pairs


def test_wildcards(spark):
    df = spark.createDataFrame([(0, "http://m.spam-farm.x.net/a"), (1, "http://spam-farms.net/"),
                                (2, "http://x.net/track/me"), (3, "http://notspam-farm.net/")], "page_id long, url string")
    rules = url_rules.rules_frame(spark, [("||spam-farm.*", "block"), ("*/track/*", "block")])
    assert {r["page_id"] for r in url_rules.judge(df, rules).filter("verdict = 'block'").collect()} == {0, 2}


@pytest.mark.parametrize("name", ["op2_url_rules", "op9_exact_dedup"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(
        map(repr, want.select(*cols).fetchall()))


def replay(key, node):
    """A placement drawn again without Spark: ``xxh64`` of the key, then of the child's name with that as its seed."""
    while node.children:
        draws = []
        for i, child in enumerate(node.children):
            h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed=42)
            h = xxhash.xxh64_intdigest(child.name.encode(), seed=h)
            draws.append((-math.log(((h >> 11) + 1) / (2 ** 53 + 1)) / child.weight, i))
        node = node.children[0] if len(node.children) == 1 else node.children[min(draws)[1]]
    return node.shard


def test_placements_are_the_weighted_hash_draws(spark):
    tree = shard_tree.balanced_tree(16)
    uneven = shard_tree.Node("root", (
        shard_tree.Node("a", (shard_tree.Node("a0", shard=0, leaf_weight=5.0), shard_tree.Node("a1", shard=1))),
        shard_tree.Node("b", shard=2, leaf_weight=0.5), shard_tree.Node("c", shard=3, leaf_weight=2.0)))
    keys = [*range(-50, 1500), 2 ** 62, -2 ** 63]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for t in (tree, shard_tree.grow(tree), uneven, shard_tree.grow(uneven, 3.0)):
        got = df.select("k", shard_tree.place("k", t).alias("s")).collect()
        assert all(r["s"] == replay(r["k"], t) for r in got)
