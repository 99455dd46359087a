"""The registered queries of this subpackage: one thin query per operator, whole tables.

Results are a few numbers per row, returned in one wave of partitions; Python
passes over texts run while a work table is made, in small batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import (
    best_fit, bit_planes, exact_dedup, license_scan, minhash, mixing, ranked_search, sentence_spans, shard_tree, sphere_caps,
    token_counts, toxicity, url_rules,
)
from tickweave.llm.work import hold, one_wave, release, table, text_bytes

# Fixed values of the url contract: (host and path, verdict).
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]

TOXIC_FROM = 0.3  # fixed value of the toxicity contract

# The method's own list, for urls that no rule above fits: host labels of junk sites.
JUNK_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def op1_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards (2 regions x 2 racks x 4), and where a 17th shard would take rows from."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (text_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    tree = shard_tree.balanced_tree(16)
    out = shard_tree.assign(docs, tree, shard_tree.grow(tree))
    return one_wave(out).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by the contract's rules, then by the junk-site list."""
    rules = url_rules.rules_frame(spark, URL_RULES, rank=1).unionByName(
        url_rules.rules_frame(spark, [(f"||{w}.*", "block") for w in JUNK_LABELS]))
    out = one_wave(url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules))
    listed = F.col("rule").isin([r for r, _ in URL_RULES])
    return out.select("page_id", "host", "path", F.when(listed, F.col("rule")).alias("rule"), "verdict",
                      F.when(~listed, F.col("rule")).alias("method_rule"))


OP2_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    regexp_extract(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.', 2) AS junk FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN junk <> '' THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL AND junk <> '' THEN '||' || junk || '.*' END AS method_rule
FROM r
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every document, with the share of the template that aligns."""
    return one_wave(hold(license_scan.scan(table(spark, sf_dir, "documents"))))


def op4_sphere_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings within their labels, cosine 0.93 or more."""
    out = one_wave(sphere_caps.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return one_wave(best_fit.pack(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of repeated sentences that is not its first occurrence in the corpus."""
    return one_wave(sentence_spans.repeated_spans(table(spark, sf_dir, "documents")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, Jaccard of 0.85 or more."""
    out = one_wave(minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, threshold_pct=85))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; labels of ids in hash bucket 2 of 4 are never learnt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.bucket4("__id") != 2)
    out = one_wave(hold(toxicity.score(docs, model).select("doc_id", "score")))
    return out.select("doc_id", F.coalesce(toxicity.bucket4() == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
                      F.lit(model.swaps).cast("long").alias("model_swaps"))  # 0: the penalty had nothing to act on


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    norm = exact_dedup.normalised("text")
    out = one_wave(exact_dedup.refine(table(spark, sf_dir, "documents"), norm, keep=["doc_id"],
                                      extra={"text_sha256": F.sha2(norm, 256)}))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM h JOIN g USING (text_sha256)
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, fitted rate and copies of every document."""
    out, _ = mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return one_wave(out).select("doc_id", "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mixing.TARGETS)],
                      "rate", "copies")


def op11_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 8 clusters after 10 rounds, in exact integers."""
    out, centroids = bit_planes.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, salt="3", scale=1024)
    digests = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()]
    digest = F.array(*digests)[F.col("cluster")] if digests else F.lit(None).cast("string")
    return out.withColumnRenamed("id", "vec_id").withColumn("centroid_sha256", digest)


def _op11_sql(k: int = 8, rounds: int = 10) -> str:
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS uid, vec_id, x, list_dot_product(x, x) AS xx
  FROM (SELECT vec_id, [floor(1024 * CAST(e AS DOUBLE)) FOR e IN embedding] AS x FROM embeddings
        WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64)),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x
  FROM kept ORDER BY sha256('3:' || vec_id) LIMIT {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (
  SELECT k.uid, c.c, k.xx + list_dot_product(c.x, c.x) - 2 * list_dot_product(k.x, c.x) AS d FROM kept k, c{r} c),
a{r} AS MATERIALIZED (
  SELECT uid, c, d FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY d, c) AS n FROM d{r}) WHERE n = 1)""")
        if r < rounds:
            parts.append(f"""s{r} AS (
  SELECT a.c, i, sum(CAST(k.x[i] AS HUGEINT)) AS s, count(*) AS n
  FROM a{r} a JOIN kept k USING (uid), range(1, 65) t(i) GROUP BY a.c, i),
m{r} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) / n AS DOUBLE) ORDER BY i) AS x FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (c))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string([CAST(CAST(e AS BIGINT) AS VARCHAR) FOR e IN c.x], ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (uid) JOIN c{rounds} c ON c.c = a.c"""


def op12_ranked_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item (a top-k report: the limit is the feature)."""
    out = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
n AS (SELECT uid, doc_id, len(words) AS n, words FROM d WHERE len(words) > 0),
c AS (SELECT count(*) AS N_, sum(n)::BIGINT AS L_ FROM n),
q AS (
  SELECT DISTINCT uid, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS uid, * FROM benchmark)),
p AS (
  SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(words) AS term FROM n)
  WHERE term IN (SELECT term FROM q) GROUP BY uid, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
g AS (
  SELECT p.uid, n.doc_id, p.term,
         w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n.n * N_) // L_))) AS gain
  FROM p JOIN w USING (term) JOIN n USING (uid), c),
s AS (
  SELECT q.uid AS item, q.item_id, g.uid, g.doc_id, sum(gain)::BIGINT AS score
  FROM q JOIN g USING (term) GROUP BY ALL HAVING sum(gain) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""


def op13_whole_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text; a flag for those over 1024 tokens."""
    return one_wave(hold(token_counts.count(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard_tree": op1_shard_tree,
    "op2_url_rules": op2_url_rules,
    "op3_license_scan": op3_license_scan,
    "op4_sphere_caps": op4_sphere_caps,
    "op5_best_fit": op5_best_fit,
    "op6_sentence_spans": op6_sentence_spans,
    "op7_minhash": op7_minhash,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_bit_planes": op11_bit_planes,
    "op12_ranked_terms": op12_ranked_terms,
    "op13_whole_tokens": op13_whole_tokens,
}
ORACLE_SQL: dict[str, str] = {"op2_url_rules": OP2_SQL, "op9_exact_dedup": OP9_SQL, "op11_bit_planes": _op11_sql(),
                              "op12_ranked_terms": OP12_SQL}


def _fresh(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Free what earlier queries hold (a result not yet written would be computed again), then run."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        release()
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _fresh(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLE_SQL.items()}
