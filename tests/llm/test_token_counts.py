"""Token ids and counts against the vocabulary file's own library, unaltered."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickweave.llm import queries, token_counts, tokens

SF = "/root/testdata/sf0.01"
PATH = tokens.vocabulary_path()
ODD = ["", " ", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x  <|endoftext|>\n\n y", "<|endoftext|",
       "  <|endoftext|>  ", "don't we'll I'M 's 't  's", "naïve   x\r\n\t", "\x1c\x1f a\x85b", "½ ² Ⅷ x²y 1²",
       "՘ ֋࢏ a\U00030000b \U0003fc3f", "漢字かな 한국어 हिन्दी عربي", "😀👩‍👩‍👧 ok", "\x00\x01 a\x00b"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def whole():
    return token_counts.whole_tokens(PATH)


def test_only_proven_strings_are_whole(whole, library):
    assert len(whole) > 40_000 and "<|endoftext|>" not in whole
    assert all(len(library(s)) == 1 for s in whole)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, whole, library):
    assert tokens.encoder(PATH)(text) == library(text)
    assert token_counts.counter(PATH, whole)(text) == len(library(text))


def test_very_long_texts(whole, library):
    count = token_counts.counter(PATH, whole)
    for text in ("word don't <|endoftext|>" * 60_000, "a" * 30_000 + " " * 30_000 + "x", "¿qué? " * 200_000):
        assert count(text) == len(library(text))


def test_random_texts(whole, library):
    ids, count = tokens.encoder(PATH), token_counts.counter(PATH, whole)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(
        st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12),
        st.sampled_from(["<|endoftext|>", " the", "ing", "  ", "\n", "'s", " 12", "...", "½"])), max_size=12))
    def check(parts):
        text = "".join(parts)
        assert ids(text) == library(text)
        assert count(text) == len(library(text))

    check()


def test_forgetting_merged_pieces_changes_nothing(monkeypatch, whole, library):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    text = " ".join(f"qx{i}zz vv{i % 5}k" for i in range(200))
    assert token_counts.counter(PATH, whole)(text) == len(library(text))


def test_rows(spark, library):
    docs = spark.createDataFrame(
        [(1, None, "a", "a", 5), (2, "", "b", "b", 6), (2, "x <|endoftext|>", None, None, None),
         (None, "é" * 3000, "c", "c", 1), (3, "word " * 1024, "d", "d", 2), (4, "word " * 1023, "e", "e", 3)],
        "doc_id long, text string, body string, row string, n_tokens int")
    out = token_counts.count(docs)
    assert out.columns == ["doc_id", "text", "body", "row", "n_bytes", "n_tokens", "over_limit"]
    got = out.collect()
    assert len(got) == 6
    for r in got:
        text = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library(text))), r
        assert r["over_limit"] == (r["n_tokens"] > 1024) and r["row"] == r["body"]
    assert token_counts.count(docs.limit(0)).count() == 0


def test_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.queries()["op13_whole_tokens"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n = len(library(text))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len(text.encode()), n, n > 1024)
