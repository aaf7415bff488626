"""Tokeniser and bigram extraction (P1-P3, X7), checked against a plain
Python statement of the rule."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bigraph.functions import normalize_text, tokenize
from bigraph.operators import bigrams as B


def reference_tokens(text):
    """The rule in plain Python: lower, drop ', non a-z runs to one space,
    strip spaces, split on one space."""
    return re.sub(r"\s+", " ", re.sub("[^a-z]+", " ", re.sub("'", "", text.lower()))).strip(" ").split(" ")


def reference_pairs(text):
    w = reference_tokens(text)
    return [(w[i], w[i + 1]) for i in range(len(w) - 1)]


CASES = [
    ("Don't stop!\nDon’t", ["dont", "stop", "don", "t"]),
    ("", [""]),
    ("123", [""]),
    ("one", ["one"]),
    ("  Café au LAIT ", ["caf", "au", "lait"]),
    ("İstanbul Kelvin", ["i", "stanbul", "kelvin"]),
    ("a--b''c", ["a", "bc"]),
]


@pytest.mark.parametrize("text,tokens", CASES)
def test_tokens_fixture(spark, text, tokens):
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(tokenize(normalize_text("text")).alias("t")).first()["t"]
    assert got == tokens
    assert got == reference_tokens(text)


def test_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "doc_id bigint, text string")
    assert df.select(normalize_text("text").alias("n")).collect()[0]["n"] is None
    pairs = B.bigrams(df, keep=("doc_id",)).collect()
    assert [(r.doc_id, r.word, r.next_word) for r in pairs] == [(2, "a", "b")]


def test_pairs_fixture(spark):
    texts = [t for t, _ in CASES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.word, r.next_word) for r in B.bigrams(df, keep=("doc_id",)).collect())
    want = sorted((i, a, b) for i, t in enumerate(texts) for a, b in reference_pairs(t))
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ '’-.\néİK1", max_size=40), min_size=1, max_size=8))
def test_pairs_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.word, r.next_word) for r in B.bigrams(df, keep=("doc_id",)).collect())
    want = sorted((i, a, b) for i, t in enumerate(texts) for a, b in reference_pairs(t))
    assert got == want


def test_tokens_with_positions(spark):
    df = spark.createDataFrame([(7, "The cat, the hat")], "doc_id bigint, text string")
    got = [(r.pos, r.token) for r in B.document_tokens(df).orderBy("pos").collect()]
    assert got == [(0, "the"), (1, "cat"), (2, "the"), (3, "hat")]
