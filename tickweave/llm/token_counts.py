"""Token counts with a whole-token shortcut.

Offline, on the driver, every string of the vocabulary is encoded alone; those
that come out as one token are proven *whole*. A text is then cut into
pre-tokens by the vocabulary's split pattern. Pre-tokens that are proven whole
count one each, by a set look-up; only the rest are merged.

The split pattern runs in ``regex``, whose Unicode tables may be newer than the
tokenizer library's. A character whose cuts differ between the two (tried once
per worker and character) sends its text to the library's own merges whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import tokens
from tickweave.llm.work import text_bytes

LONG = 1 << 20  # characters from which a text's pre-tokens are read one by one, not listed
REMEMBERED = 300_000  # merged pre-tokens a worker remembers before it forgets them all


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings that ``tokenizers`` encodes, standing alone, as one token (bounded by the vocabulary)."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or \
            spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    byte, special = tokens.byte_level_alphabet(), tokens.added_tokens(spec)
    known = Tokenizer.from_file(path)
    strings = []
    for token in spec["model"]["vocab"]:
        if token not in special:
            try:
                strings.append(bytes(byte[c] for c in token).decode())
            except UnicodeDecodeError:  # part of a character: never a pre-token
                pass
    alone = known.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, alone) if len(e.ids) == 1)


class _Merged(dict):
    """Numbers of tokens of pre-tokens that were merged; forgets them all when there are too many."""

    def __init__(self, merge: Callable[[str], list[int]]):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[piece] = len(self.merge(piece))
        return n


def counter(path: str, whole: frozenset[str]) -> Callable[[str], int]:
    """A function of a text giving its number of tokens."""
    import public_tokenizers
    from tokenizers import Tokenizer

    split = regex.compile(public_tokenizers.PATTERN)
    merge = tokens.merges(path)
    with open(path, encoding="utf-8") as f:
        cuts = tokens.cutter(json.load(f))
    library = Tokenizer.from_file(path).pre_tokenizer
    same: set[str] = set()  # characters that both libraries cut alike
    other: set[str] = set()
    merged = _Merged(merge).__getitem__

    def prove(chars: set[str]) -> None:
        for c in chars:
            text = f"a{c}1{c} {c},"  # beside a letter, a digit, a blank and a sign
            alike = [m.span() for m in split.finditer(text)] == [at for _, at in library.pre_tokenize_str(text)]
            (same if alike else other).add(c)

    def plain(text: str) -> int:
        chars = set(text)
        if not chars <= same:
            prove(chars - same - other)
            if not chars <= same:
                return len(merge(text))
        if len(text) >= LONG:
            return sum(1 if (p := m.group()) in whole else merged(p) for m in split.finditer(text))
        pieces = split.findall(text)
        rest = [p for p in pieces if p not in whole]
        return len(pieces) - len(rest) + sum(map(merged, rest))

    def count(text: str) -> int:
        if cuts is None or not cuts.search(text):
            return plain(text)
        parts = cuts.split(text)  # plain parts and added tokens by turns
        return len(parts) // 2 + sum(plain(p) for p in parts[::2])

    return count


def n_tokens(text: str, path: str | None = None) -> F.Column:
    """Number of tokens of a text column, by the vocabulary file at ``path``; a null text has none."""
    path = path or tokens.vocabulary_path()
    whole = whole_tokens(path)

    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path, whole)
        for texts in batches:
            yield pa.array([count(t.as_py() or "") for t in texts], pa.int64())

    return counts(F.col(text))


def count(docs: DataFrame, path: str | None = None, limit: int = 1024, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    Counts are those of ``tokenizers`` by default, without begin and end
    tokens: an added token of the file that stands in a text counts one. Null
    and empty texts have 0 bytes and 0 tokens. All columns come back, those
    three replaced; repeated rows are counted each; empty tables give no rows.
    A very long text costs memory for itself alone. No shuffle.
    """
    own = ("n_bytes", "n_tokens", "over_limit")
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    # The text travels under a name of this step's own; nested rows cannot clash with it.
    rows = docs.select(F.struct(*keep).alias("row"), F.col(f"`{text_col}`").alias("body"))
    rows = rows.select("row", text_bytes("body").alias("n_bytes"), n_tokens("body", path).alias("n_tokens"))
    return rows.select("row.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
