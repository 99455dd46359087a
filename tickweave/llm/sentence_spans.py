"""Substring dedup by sliding sentence spans.

Every run of several consecutive sentences is hashed and met with all others of
the corpus; of a repeated run the first occurrence stays, and sentences covered
by any other occurrence are removed. Sentences end at ``.``, ``!``, ``?``, at
the marks of other scripts or at a line end, and long ones also at commas, so
that a passage of two long sentences still holds several. A run is as short as it can be with ``run`` sentences and
``least_words`` words, taken from each sentence forwards and from each sentence
backwards: so every passage that holds a run is covered from its first whole
sentence to its last, and chance repeats of a few short sentences are not runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.work import ID, TEXT, apart, hold, whole_rows

# Sentence ends and commas: Latin marks before white space, and those of other scripts (CJK, Indic, Arabic, Armenian,
# Ethiopic, Khmer, Burmese), which stand without it.
BREAK = re.compile(r"[.!?]+[\"'”’»)\]]*(?=\s|$)|[\u3002\uff01\uff1f\uff0e\uff61\u0964\u0965\u061f\u06d4\u0589\u1362\u17d4\u104b]+|\n+")
COMMA = re.compile(r"[,;:](?=\s)|[\u3001\uff0c\uff1b\uff1a\u060c\u061b]")
WORD = re.compile(r"\w")
# Words lie between white space and marks: ASCII ones, and those of Latin-1, general and CJK punctuation and the ends above.
SPACED = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))
RANGES = [(0xa1, 0xa1), (0xab, 0xab), (0xb7, 0xb7), (0xbb, 0xbb), (0xbf, 0xbf), (0x2010, 0x2027), (0x2030, 0x205e), (0x3001, 0x303f),
          (0xff01, 0xff0f), (0xff1a, 0xff20), (0xff3b, 0xff40), (0xff5b, 0xff65), (0x964, 0x965), (0x60c, 0x60c), (0x61b, 0x61b),
          (0x61f, 0x61f), (0x6d4, 0x6d4), (0x589, 0x589), (0x1362, 0x1362), (0x17d4, 0x17d4), (0x104b, 0x104b)]
MARKS = frozenset(chr(c) for a, b in RANGES for c in range(a, b + 1))
ASCII = bytes(range(128))
# Characters of scripts written without blanks (Han, Kana, Thai, Lao, Burmese, Khmer): each counts as a word.
UNSPACED = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e01-\u0eff\u1000-\u109f\u1780-\u17d3]")
LONG = 24  # words from which a sentence is also cut at commas


def word_count(words: list[str]) -> int:
    """Words of a sentence; where blanks do not part them, characters."""
    return sum(1 if w.isascii() else max(1, len(UNSPACED.findall(w))) for w in words)


def spaced(text: str) -> str:
    """A text in lower case with its marks as blanks, character for character."""
    low = text.lower()
    if len(low) != len(text):  # a few capitals become two characters: those stay
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    raw = low.encode("utf-8", "surrogatepass")
    if len(raw) != len(low):
        for c in MARKS.intersection(raw.translate(None, ASCII).decode("utf-8", "surrogatepass")):
            low = low.replace(c, " ")
        raw = low.encode("utf-8", "surrogatepass")
    return raw.translate(SPACED).decode("utf-8", "surrogatepass")


def sentences(text: str | None, long: int = LONG) -> list[tuple[int, int, int, bytes]]:
    """``(start, end, words, normal form)`` of a text's sentences, in characters; those without a letter are left out.

    The normal form is the lower-case words with single spaces: quotes, dashes,
    commas and final marks do not tell sentences apart.
    """
    out = []
    text = text or ""
    low, plain = spaced(text), text.isascii() or not UNSPACED.search(text)

    def add(lo: int, hi: int, cut_long: bool) -> None:
        part = low[lo:hi]
        words = part.split()
        n = len(words) if plain else word_count(words)
        if cut_long and n > long:
            at = lo
            for m in COMMA.finditer(text, lo, hi):
                add(at, m.end(), False)
                at = m.end()
            add(at, hi, False)
        elif words and WORD.search(part):
            out.append((lo, hi, n, " ".join(words).encode("utf-8", "surrogatepass")))

    at = 0
    for m in BREAK.finditer(text):
        add(at, m.end(), True)
        at = m.end()
    add(at, len(text), True)
    return out


def runs(words: list[int], run: int, least_words: int) -> list[tuple[int, int]]:
    """``(first, last)`` sentence of every run, from each sentence forwards and backwards."""
    n = len(words)
    total = [0]
    for w in words:
        total.append(total[-1] + w)
    out = set()
    last = 0
    for first in range(n):  # the least last sentence never moves back
        last = max(last, first + run - 1)
        while last < n and total[last + 1] - total[first] < least_words:
            last += 1
        if last >= n:
            break
        out.add((first, last))
    first = n - 1
    for last in range(n - 1, -1, -1):
        first = min(first, last - run + 1)
        while first >= 0 and total[last + 1] - total[first] < least_words:
            first -= 1
        if first < 0:
            break
        out.add((first, last))
    return sorted(out)


def _hash_runs(run: int, least_words: int, long: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for at, (row, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                found = sentences(text.as_py(), long)
                for a, b in runs([s[2] for s in found], run, least_words):
                    h = xxhash.xxh3_128_intdigest(b"\n".join(s[3] for s in found[a:b + 1]))
                    out.append((at, (h >> 64) - 2 ** 63, (h & (2 ** 64 - 1)) - 2 ** 63, row, a << 32 | b,
                                found[a][0] << 32 | found[b][1]))
                if len(out) > 50_000:
                    yield _batch(batch, out)
                    out = []
            yield _batch(batch, out)
    return work


RUNS = "h long, h2 long, row long, places long, chars long"


def _batch(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    at, *cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 6)]
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), *cols],
                                      names=["doc", "h", "h2", "row", "places", "chars"])


def repeated_spans(docs: DataFrame, run: int = 3, least_words: int = 12, long: int = LONG, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The spans to remove: one row per maximal stretch of repeated sentences that is not their first occurrence.

    ``doc_id``, ``row`` (tells rows of one id apart), ``first_sentence``,
    ``last_sentence``, ``start``, ``end`` (characters), ``first_doc`` (smallest
    id that holds the first of its runs). "First" is by id (nulls last), then
    row, then place. Repeats within a document count. Null and empty texts and
    texts shorter than a run give no rows. Other columns are not read.

    Texts are hashed twice so that runs need not be kept: 64 bits of every hash
    are counted with map-side sums, and only runs whose 64 bits are met again
    are read as rows. A run that a third of all documents share is one count
    per task, and its rows meet that count in a join AQE can split.
    """
    base = docs.select(F.col(id_col).alias("doc"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).alias("text"))
    kind = base.schema["doc"].dataType.simpleString()
    found = base.mapInArrow(_hash_runs(run, least_words, long), f"doc {kind}, {RUNS}")
    again = found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h", apart("h").alias("apart"))
    shared = hold(found.withColumn("apart", apart("h")).join(again, ["h", "apart"], "left_semi")
                  .withColumn("first", F.shiftright("places", 32)).drop("apart"))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "first")
    firsts = shared.groupBy("h", "h2").agg(F.min(place).alias("low"), F.count("*").alias("n")).filter("n > 1").select(
        "h", "h2", apart("h", "h2").alias("apart"), "low")
    low_half = F.lit(2 ** 32 - 1)
    later = (shared.withColumn("apart", apart("h", "h2")).join(firsts, ["h", "h2", "apart"])
             .filter((F.col("row") != F.col("low.row")) | (F.col("first") != F.col("low.first")))
             .select("doc", "row", "first", F.col("places").bitwiseAND(low_half).alias("last"),
                     F.shiftright("chars", 32).alias("lo"), F.col("chars").bitwiseAND(low_half).alias("hi"),
                     F.col("low.doc").alias("of")))
    # Runs of one document that share or touch sentences form one stretch.
    order = Window.partitionBy("row").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("opens", (F.coalesce(reach, F.lit(-2)) + 1 < F.col("first")).cast("int"))
    stretch = marked.withColumn("stretch", F.sum("opens").over(order))
    return stretch.groupBy("row", "stretch").agg(
        F.first("doc").alias("doc_id"), F.min("first").cast("int").alias("first_sentence"),
        F.max("last").cast("int").alias("last_sentence"), F.min("lo").cast("int").alias("start"),
        F.max("hi").cast("int").alias("end"), F.min("of").alias("first_doc")).drop("stretch")


def _remove(spans: list | None, text: str | None) -> str | None:
    for s in sorted(spans or [], reverse=True):
        text = text[:s[0]] + text[s[1]:]
    return text


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated spans taken out of the text; every row and column comes back.

    Rows of equal id and text lose the spans of both (exact dedup tells them apart).
    """
    whole = whole_rows(docs, id_col, text_col).withColumn("key", F.xxhash64(TEXT))
    keyed = whole.select(F.struct(F.col(ID).alias("id"), "key").alias("k"), F.col(TEXT).alias("t"))
    spans = (repeated_spans(keyed, id_col="k", text_col="t", **options).groupBy("doc_id")
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    spans = spans.select(F.col("doc_id.id").alias("of"), F.col("doc_id.key").alias("of_key"), "spans")

    @F.pandas_udf("string")
    def clean(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            yield pd.Series([t if f is None else _remove([(s["start"], s["end"]) for s in f], t)
                             for t, f in zip(texts, found)], dtype=object)

    joined = whole.join(spans, F.col(ID).eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    cleaned = joined.withColumn("cleaned", clean(F.col(TEXT), F.col("spans")))
    return cleaned.select(*[F.col("cleaned" if c == text_col else f"__row.`{c}`").alias(c) for c in docs.columns])
