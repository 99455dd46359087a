"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a line of filter text. Its literal tokens are the complete host
labels and path words it contains; the rarest of them over all urls is the
rule's index token. The tokens of a url fetch candidate rules with one
equi-join, and only candidates run their regular expression.

Rule text:

* ``host/path``  fits the host and its subdomains if the url's path starts with ``/path``;
* ``||label*``   fits a host label that starts so, ``*`` is any run of characters;
* ``*text*``     fits anywhere in ``host + path``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.work import apart, ascii_lower, hold

RULE_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()),
    T.StructField("rank", T.IntegerType()), T.StructField("regex", T.StringType()),
    T.StructField("tokens", T.ArrayType(T.StringType()))])


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: str | Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def compile_rule(text: str) -> tuple[str, list[str]]:
    """The regular expression of a rule over ``host + path``, and its complete literal tokens.

    A token is complete where a ``.``, a ``/`` or the host's start or end
    bounds it on both sides; one beside ``*``, or last in a path prefix, may be
    part of a longer token in the url and cannot serve as an index token.
    """
    if text.startswith("||") or text.startswith("*"):
        body = text.removeprefix("||")
        lead = r"(?s)^(?:[^/]*\.)?" if text.startswith("||") else "(?s)"
        regex = lead + "".join(".*" if p == "*" else re.escape(p) for p in re.split(r"(\*)", body) if p)
        bounded = ("." if text.startswith("||") else "*") + body + "*"
    else:
        host, slash, path = text.partition("/")
        regex = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + path)
        bounded = "." + host + ("/" + path if slash else "") + "*"
    return regex, sorted(set(re.findall(r"(?<=[./])[^./*]+(?=[./])", bounded)))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]], rank: int = 0) -> DataFrame:
    """``(rule, verdict)`` pairs as a rule table; a higher ``rank`` outranks any length."""
    return spark.createDataFrame([(r, v, rank, *compile_rule(r)) for r, v in rules], RULE_SCHEMA)


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a url, and the empty token that fetches rules without one of their own."""
    return F.array_union(F.array(F.lit("")), F.array_distinct(F.split(F.concat(host, path), r"[./]+")))


def index_rules(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Each rule under its rarest literal token over all urls (``url_tokens``: a row per url and token)."""
    lit = rules.select("rule", F.explode_outer("tokens").alias("token")).fillna("", ["token"])
    wanted = lit.select("token").distinct()
    counts = url_tokens.groupBy("token").agg(F.count("*").alias("n")).join(wanted, "token", "left_semi")
    rarest = (lit.join(counts, "token", "left").fillna(0, ["n"])
              .groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("token")))
    return rules.join(rarest, "rule").select("token", "rule", "verdict", "rank", "regex")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` per row.

    The fitting rule of the highest rank wins, then the longest, then the
    first in code-point order; without one ``rule`` is null and ``verdict`` is
    ``default``. Null urls and urls without ``://`` have an empty host and path.
    All columns of ``pages`` come back; the four named above are replaced.
    Repeated urls are judged once and keep all their rows. Empty tables give
    no rows; an empty rule table gives the default everywhere.
    """
    own = ("host", "path", "rule", "verdict")
    cols = [c for c in pages.columns if c not in own]
    keyed = pages.select(*[F.col(c) for c in cols], host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    urls = hold(pages.select(host_of(url_col).alias("host"), path_of(url_col).alias("path")).distinct())
    words = urls.select("host", "path", F.explode(tokens_of(F.col("host"), F.col("path"))).alias("token"))
    index = hold(index_rules(rules, words.select("token")))
    # Candidates: only rules whose index token the url has run their expression.
    fits = (words.join(index, "token")
            .filter(F.expr("concat(host, path) rlike regex"))
            .groupBy("host", "path")
            .agg(F.min(F.struct(-F.col("rank"), -F.length("rule"), "rule", "verdict")).alias("__b")))
    fits = fits.select("host", "path", apart("host", "path").alias("__apart"), F.col("__b.rule").alias("rule"),
                       F.col("__b.verdict").alias("verdict"))
    return (keyed.withColumn("__apart", apart("host", "path")).join(fits, ["host", "path", "__apart"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
            .select(*cols, *own))
