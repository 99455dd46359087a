"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each step groups only what the step before could not tell apart. The full
content is hashed only for rows whose (length, prefix hash) another row shares;
every other row is settled by its length and first bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.work import BLANK, ID, TEXT, apart, hold, whole_rows

PREFIX = 256
SALTS = 16  # parts that the rows of one length and prefix are dealt into


def normalised(text: str | Column) -> Column:
    """Each run of white space as one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")


def refine(docs: DataFrame, text: Column, id_col: str = "doc_id", prefix: int = PREFIX,
           extra: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size`` and ``kept`` per row.

    ``text``: the expression whose values are compared, byte by byte (all of
    it; null counts as empty). Of equal texts the row with the smallest
    ``id_col`` stays (nulls last; of rows that repeat that id, one stays).
    ``keep``: the columns of ``docs`` that come back (default: all), with
    ``extra`` expressions over its rows; ``keep_id``, ``group_size`` and
    ``kept`` of the input are replaced. Empty tables give no rows.

    Shuffles: lengths and prefix hashes are counted with map-side sums; texts
    move once, to meet the counts. A group of copies of any size is counted
    before it is shuffled; its rows meet the counts in ``SALTS`` parts, and the
    second join can be split by AQE (each side is an exchange of its own).
    """
    own = ("keep_id", "group_size", "kept")
    extra = extra or {}
    cols = [c for c in (docs.columns if keep is None else keep) if c not in own and c not in extra]
    body = F.coalesce(text, F.lit(""))
    # What a step needs travels beside the row's own columns, which go as one struct: no name can clash.
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in cols], *[e.alias(c) for c, e in extra.items()])
    rows = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), body.alias("text"),
                       F.monotonically_increasing_id().alias("uid"))
    rows = rows.withColumn("len", F.octet_length("text")).withColumn("pre", F.xxhash64(F.substring("text", 1, prefix)))
    # 1, 2: lengths met twice, and within them prefixes met twice.
    light = docs.select(body.alias("text")).select(
        F.octet_length("text").alias("len"), F.xxhash64(F.substring("text", 1, prefix)).alias("pre"))
    pairs = light.groupBy("len", "pre").agg(F.count("*").alias("n"))
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("in_len")).filter("in_len > 1")
    # A hot pair's rows are dealt by salt: few enough pairs are met twice that each may stand once per salt.
    alike = pairs.filter("n > 1").join(lengths, "len", "left_semi").select(
        "len", "pre", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("alike"))
    # 3: the full hash, for those rows only.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    members = hold(salted.join(alike, ["len", "pre", "salt"], "left")
                   .withColumn("full", F.when(F.col("alike"), F.sha2("text", 256))).drop("text", "alike", "salt"))
    key = ["len", "pre", "full"]
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("uid").alias("uid")))
    groups = (members.filter("full is not null").groupBy(*key)
              .agg(first.alias("first"), F.count("*").alias("size")).filter("size > 1")
              .withColumn("apart", apart(*key)))
    return (members.withColumn("apart", apart(*key)).join(groups, [*key, "apart"], "left")
            .select("row.*", F.coalesce(F.col("first.id"), F.col("id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("first.uid") == F.col("uid"), F.lit(True)).alias("kept")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``, whatever their names."""
    rows = whole_rows(docs, id_col, text_col)
    return refine(rows, normalised(TEXT), ID, keep=["__row", ID]).filter("kept").select("__row.*")
