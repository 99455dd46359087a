"""Sparse text features and a small linear classifier trained on a bounded sample.

A text's features are the set of its words, of their first letters (so that
inflected and compound forms share evidence), and of binned shape figures. The
sample is bounded by a parameter; everything else runs over all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.work import hold

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
ASCII = bytes(range(128))
# What is no word character in ASCII as a blank; bytes of other characters as they are.
SPACED = bytes(b if b >= 128 or WORD.match(chr(b)) else 32 for b in range(256))
PART = 1 << 20  # values added up at once
TOGETHER = 4 << 20  # characters of texts that are scored together (a longer text by itself)


def word_features(words: set[str]) -> set[str]:
    """Names of the features of distinct words: the word, and its first letters marked by a star."""
    out = set(words)
    for k in PREFIXES:
        out.update([w[:k] + "*" for w in words if len(w) >= k])
    return out


def shape_features(text: str, words: int, distinct: int, letters: int, longest: int) -> list[str]:
    """One feature per figure and bin: repetition, symbols, digits, capitals, word length, line repetition.

    ``words``, ``distinct``: number of words and of different ones; ``letters``:
    characters in them; ``longest``: of the longest.
    """
    n, m = max(1, len(text)), max(1, words)
    blanks = text.count(" ") + text.count("\n") + 1
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    raw = text.encode("utf-8", "surrogatepass")
    figures = {
        "distinct": distinct / m, "symbols": 1 - letters / n - (blanks - 1) / n, "glued": m / blanks,
        "digits": (len(raw) - len(raw.translate(None, b"0123456789"))) / n, "length": letters / m / 10,
        "lines": len(set(lines)) / len(lines), "perline": min(1.0, m / len(lines) / 100),
        "longest": longest / 40, "bars": text.count("|") / blanks,
        "stops": (text.count(".") + text.count(",")) / blanks}
    return [f"#{k}:{min(20, int(v * 10))}" for k, v in figures.items()]


def read(text: str | None) -> tuple[str, list[str]]:
    text = text or ""
    return text, WORD.findall(text.lower())


def features(text: str, words: list[str]) -> tuple[list[str], set[str]]:
    """Shape features and word features of a text and its words."""
    distinct = set(words)
    shape = shape_features(text, len(words), len(distinct), sum(map(len, words)), max(map(len, words), default=0))
    return shape, word_features(distinct)


def _once(keys: np.ndarray) -> np.ndarray:
    """Different keys, in order."""
    keys = np.sort(keys)
    return keys[np.diff(keys, prepend=-1) != 0]


@dataclass
class Words:
    """The words (as :func:`read` gives them) of several texts, each different word once."""

    texts: list[str]
    distinct: pa.Array  # different words
    size: np.ndarray  # characters of each
    text: np.ndarray  # occurrences in order: the text,
    word: np.ndarray  # and which different word
    once: tuple[np.ndarray, np.ndarray]  # the same, each word of a text once

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        raws = []
        for text in texts:
            low = text.lower()
            raw = low.encode("utf-8", "surrogatepass")
            if len(raw) != len(low):  # other characters than ASCII: what is no word character becomes a blank
                for c in set(raw.translate(None, ASCII).decode("utf-8", "surrogatepass")):
                    if not c.isalnum():
                        low = low.replace(c, " ")
                raw = low.encode("utf-8", "surrogatepass")
            raws.append(raw.translate(SPACED))
        ends = np.cumsum([len(r) + 1 for r in raws])
        data = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
        letter = data != 32
        edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
        starts, stops = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[letter]))
        coded = words.dictionary_encode()
        text, word = np.searchsorted(ends, starts, side="right"), coded.indices.to_numpy().astype(np.int64)
        some = max(1, len(coded.dictionary))
        return cls(texts, coded.dictionary, pc.utf8_length(coded.dictionary).to_numpy(), text, word,
                   np.divmod(_once(text * some + word), some))

    def shapes(self) -> Iterator[list[str]]:
        """Shape features of each text."""
        n = len(self.texts)
        count = np.bincount(self.text, minlength=n)
        different = np.bincount(self.once[0], minlength=n)
        sizes = self.size[self.word]
        letters = np.bincount(self.text, sizes, n).astype(int)
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, self.text, sizes)
        return map(shape_features, self.texts, count.tolist(), different.tolist(), letters.tolist(), longest.tolist())


@dataclass
class Model:
    """``score = softmax`` (or sigmoid, for one class) of ``bias + sum of weights`` of the features present."""

    bias: np.ndarray
    weights: dict[str, tuple[float, ...]] = field(default_factory=dict)
    swaps: int = 0  # counterfactual pairs of the sample that differ in a feature of the model

    def scorer(self):
        """A function of texts giving, for each, its number of words and class posteriors (for one class: its probability)."""
        names = list(self.weights)
        weights = np.array([self.weights[n] for n in names]).reshape(len(names), len(self.bias))
        at = {n: i for i, n in enumerate(names)}
        kinds = [(0, [n for n in names if n[0] != "#" and n[-1] != "*"])]
        kinds += [(k, [n for n in names if n[-1] == "*" and len(n) == k + 1]) for k in PREFIXES]
        known = [(k, pa.array([n[:k] if k else n for n in ns], pa.large_string()), np.array([at[n] for n in ns], np.int64))
                 for k, ns in kinds if ns]

        def together(texts: list[str]) -> list[tuple[int, list[float]]]:
            words, n, size = Words.of(texts), len(texts), len(names)
            text, word = words.once
            keys = [np.array([t * size + at[f] for t, fs in enumerate(words.shapes()) for f in fs if f in at], np.int64)]
            for k, values, places in known:
                part = pc.utf8_slice_codeunits(words.distinct, 0, k) if k else words.distinct
                found = pc.fill_null(pc.index_in(part, values), -1).to_numpy().astype(np.int64)
                if k:
                    found[words.size < k] = -1
                found = found[word]
                keys.append(text[found >= 0] * size + places[found[found >= 0]])
            keys = _once(np.concatenate(keys))  # each feature of a text once, in order
            owner, feature = np.divmod(keys, max(1, size))
            sums = _Sums(np.bincount(owner, minlength=n))
            z = [b + sums(np.ascontiguousarray(weights[:, c]), feature) for c, b in enumerate(self.bias)]
            count = np.bincount(words.text, minlength=n).tolist()
            if len(z) == 1:
                return [(m, [x]) for m, x in zip(count, (1 / (1 + np.exp(-np.clip(z[0], -30, 30)))).tolist())]
            e = np.exp(np.stack(z, axis=1) - np.max(z, axis=0)[:, None])
            return list(zip(count, (e / e.sum(axis=1, keepdims=True)).tolist()))

        def posteriors(texts: Iterable[str | None]) -> list[tuple[int, list[float]]]:
            out, part, held = [], [], 0
            for text in texts:
                if part and held + len(text or "") > TOGETHER:
                    out += together(part)
                    part, held = [], 0
                part.append(text or "")
                held += len(text or "")
            return out + (together(part) if part else [])

        return posteriors

    def column(self, text: str, count: bool = False) -> F.Column:
        """Posteriors of a text column, as ``array<double>``; with ``count``, the number of words before them."""
        model = self

        @F.arrow_udf("array<double>")
        def posteriors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            scored = model.scorer()
            for texts in batches:
                both = scored(t.as_py() for t in texts)
                yield pa.array([[float(n), *p] if count else p for n, p in both], pa.list_(pa.float64()))

        return posteriors(F.col(text))


def sample(docs: DataFrame, labels: DataFrame, label: F.Column, limits: dict, id_col: str = "doc_id",
           text_col: str = "text", swaps=None) -> DataFrame:
    """A bounded sample of labelled documents as ``y, key, ids, pairs``: at most ``limits[y]`` label rows of each ``y``.

    Rows are taken in the order of a hash of their id, so the sample does not
    depend on how the tables are stored. Only the sampled ids are joined to the
    texts (broadcast: their number is bounded by ``limits``); equal texts
    (``key``) are taken once. ``swaps``: a function of a text giving
    counterfactual pairs of feature sets, kept as what each swap removes and adds.
    """
    rows = labels.select(F.col(id_col).alias("__id"), label.cast("int").alias("__y")).filter("__id is not null")
    picked = None
    for y, most in limits.items():
        part = rows.filter(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.groupBy("__id").agg(F.max("__y").alias("y"))
    texts = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
             .join(F.broadcast(picked), "__id").select("y", "text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys, keys, ids, pairs = [], [], [], []
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py()
                text, words = read(t)
                shape, names = features(text, words)
                ys.append(y)
                keys.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1)
                ids.append([*shape, *sorted(names)])
                pairs.append([sorted(a) for one, other in (swaps(t) if swaps else []) for a in
                              (one - other, other - one)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.int32()), pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.string())),
                 pa.array(pairs, pa.list_(pa.list_(pa.string())))], names=["y", "key", "ids", "pairs"])

    got = texts.mapInArrow(extract, "y int, key long, ids array<string>, pairs array<array<string>>")
    return hold(got.groupBy("key").agg(F.min_by(F.struct("y", "ids", "pairs"), "y").alias("g")).select("key", "g.*"))


def fit(got: DataFrame, classes: list[int], prior: list[float], least_docs: int = 4, least_z: float = 4.0,
        l2: float = 2e-4, swap_penalty: float = 0.0, steps: int = 250, rate: float = 0.08) -> Model:
    """Train on :func:`sample`'s rows. ``prior``: the classes' true shares, to undo the sample's balance.

    One class of two is a logistic, more a softmax. Features are counted by
    class in Spark; the driver gets each that is in ``least_docs`` documents or
    more and whose share differs between classes by ``least_z`` standard errors,
    and the sample's rows cut down to those. Only the sample bounds their number.
    ``swap_penalty`` weighs the mean squared change of the score when identity
    terms are swapped.
    """
    k = len(classes)
    prior = np.maximum(np.array(prior, float), 1e-6)
    prior = prior / prior.sum()
    base = np.log(prior)
    outs = 1 if k == 2 else k
    bias = np.array([base[1] - base[0]]) if outs == 1 else base.copy()
    n = dict(got.groupBy("y").count().collect())  # at most k rows
    n = np.array([n.get(c, 0) for c in classes], float)
    if (n > 0).sum() < 2:
        return Model(bias)
    names = _telling(got, classes, n, least_docs, least_z)
    if not len(names):
        return Model(bias)
    data = _cut_down(got, names).toArrow().sort_by("key").combine_chunks()  # bounded by the sample
    at, swaps = data["at"].combine_chunks(), data["swaps"].combine_chunks().flatten()
    y = np.searchsorted(classes, data["y"].to_numpy())
    wide = at.value_lengths().to_numpy()
    col = at.flatten().to_numpy()  # int32: places of a row's features, row after row
    row_of = np.repeat(np.arange(len(y), dtype=np.int32), wide)[np.argsort(col, kind="stable")]  # by feature
    by_row, by_col = _Sums(wide), _Sums(np.bincount(col, minlength=len(names)))
    del data, at
    size = swaps.value_lengths().to_numpy()
    pairs = np.count_nonzero(size)
    pr = np.repeat(np.arange(len(size)), size)
    signed = swaps.flatten().to_numpy().astype(int)  # signed places: +i + 1 removed, -i - 1 added
    pc, ps = np.abs(signed) - 1, np.sign(signed).astype(float)
    wt = (prior / np.maximum(n, 1) * len(y))[y]  # restores the true shares
    target = (y == 1).astype(float)[:, None] if outs == 1 else np.eye(k)[y]
    w, b = np.zeros((outs, len(names))), bias
    m = [np.zeros_like(w), np.zeros_like(b)]
    v = [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        logit = b + np.stack([by_row(w[c], col) for c in range(outs)], axis=1)
        if outs == 1:
            post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        else:
            post = np.exp(logit - logit.max(axis=1, keepdims=True))
            post /= post.sum(axis=1, keepdims=True)
        r = (post - target) * wt[:, None] / len(y)
        gw = np.stack([by_col(np.ascontiguousarray(r[:, c]), row_of) for c in range(outs)]) + l2 * w
        if swap_penalty and pairs:
            for c in range(outs):
                change = np.bincount(pr, ps * w[c].take(pc), len(size))
                gw[c] += 2 * swap_penalty / pairs * np.bincount(pc, ps * change[pr], len(names))
        for i, (x, g) in enumerate(((w, gw), (b, r.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            x -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    keep = np.abs(w).max(axis=0) > 1e-3
    return Model(b, {f: tuple(x) for f, x in zip(names[keep].tolist(), w.T[keep].tolist())}, int(pairs))


class _Sums:
    """Sums over groups of ``table[index]``, where the index lies in order of the groups; made in parts, to save memory."""

    def __init__(self, sizes: np.ndarray):
        ends = np.cumsum(sizes)
        self.size, self.there = len(sizes), np.nonzero(sizes)[0]  # a group without values has the sum 0
        self.starts = (ends - sizes)[self.there]
        self.stops = ends[self.there]
        self.parts = [0] if len(self.there) else []
        while self.parts and self.parts[-1] < len(self.there):
            first = self.parts[-1]
            self.parts.append(max(first + 1, int(np.searchsorted(self.stops, self.starts[first] + PART, side="right"))))

    def __call__(self, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        for a, b in zip(self.parts, self.parts[1:]):
            lo, hi = self.starts[a], self.stops[b - 1]
            out[self.there[a:b]] = np.add.reduceat(table.take(index[lo:hi]), self.starts[a:b] - lo)
        return out


def _telling(got: DataFrame, classes: list[int], n: np.ndarray, least_docs: int, least_z: float) -> np.ndarray:
    """Names of all features that tell classes apart, in ascending order."""
    total = float(n.sum())
    df = got.select("y", F.explode("ids").alias("id")).groupBy("id").agg(
        F.count("*").cast("double").alias("n"), *[F.sum((F.col("y") == c).cast("double")).alias(f"n{i}")
                                                  for i, c in enumerate(classes)])
    p = F.col("n") / total
    z = [F.abs(F.col(f"n{i}") / float(x) - (F.col("n") - F.col(f"n{i}")) / float(total - x))
         / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * float(1 / x + 1 / (total - x)))
         for i, x in enumerate(n) if 0 < x < total]
    best = (df.filter(F.col("n") >= least_docs).select("id", F.greatest(*z, F.lit(0.0)).alias("z"))
            .filter(F.col("z") >= least_z))
    return np.array(sorted(r["id"] for r in best.collect()), dtype=object)


def _cut_down(got: DataFrame, names: np.ndarray) -> DataFrame:
    """``y, key``, the places of a row's features in ``names``, and of its swaps (signed, from 1)."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {x: i for i, x in enumerate(names)}
        for batch in batches:
            mine = [[at[i] for i in ids if i in at] for ids in batch.column(2).to_pylist()]
            swaps = []
            for ps in batch.column(3).to_pylist():
                swaps.append([[at[i] + 1 for i in ps[j] if i in at] + [-at[i] - 1 for i in ps[j + 1] if i in at]
                              for j in range(0, len(ps or []), 2)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(mine, pa.list_(pa.int32())),
                 pa.array(swaps, pa.list_(pa.list_(pa.int32())))], names=["y", "key", "at", "swaps"])

    return got.select("y", "key", "ids", "pairs").mapInArrow(
        places, "y int, key long, at array<int>, swaps array<array<int>>")
