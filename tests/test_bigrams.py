"""Bigram counts and probabilities (A1-A5, J5, T1, T3, W1, X3, X4, X10):
independent recomputation in Python, invariants, pairs == stripes, and hot
words split into several stripes."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bigraph.operators import bigrams as B
from bigraph.sources import documents

from .conftest import SF_SMALL
from .test_text import reference_pairs


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_SMALL)


@pytest.fixture(scope="module")
def expected(docs):
    """Counts recomputed on one machine, as the reference's check script did."""
    pairs = Counter()
    for r in docs.select("text").collect():
        pairs.update(reference_pairs(r.text))
    totals = defaultdict(int)
    for (w, _), n in pairs.items():
        totals[w] += n
    probs = {(w, x): n / totals[w] for (w, x), n in pairs.items()}
    return pairs, totals, probs


@pytest.fixture(scope="module")
def counts(docs):
    return B.bigram_counts(B.bigrams(docs)).cache()


def test_counts_and_totals(counts, expected):
    pairs, totals, _ = expected
    assert {(r.word, r.next_word): r.n for r in counts.collect()} == dict(pairs)
    assert {r.word: r.total for r in B.word_totals(counts).collect()} == dict(totals)


def test_probabilities_exact(counts, expected):
    got = {(r.word, r.next_word): r.probability for r in B.bigram_probabilities(counts).collect()}
    assert got == expected[2]
    assert not any(x == "*" for _, x in got)  # no marginal rows in the output


def test_probabilities_sum_to_one(counts):
    sums = B.bigram_probabilities(counts).groupBy("word").agg(F.sum("probability").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_stripes_equal_pairs(counts):
    a = {(r.word, r.next_word): r.probability for r in B.bigram_probabilities(counts).collect()}
    b = {(r.word, r.next_word): r.probability
         for r in B.bigram_probabilities_from_stripes(B.stripes(counts)).collect()}
    assert a == b


def test_hot_words_are_split(counts, expected):
    """With a tiny bound every word with more than 5 followers is cut into
    parts; the parts hold every follower once and the results do not change."""
    s = B.stripes(counts, max_entries=5).cache()
    assert s.where("parts > 1").count() > 0
    assert s.agg(F.max(F.size("stripe"))).first()[0] < 5 * 4  # hash parts stay near the bound
    entries = s.select("word", F.explode("stripe").alias("next_word", "n"))
    assert entries.count() == counts.count()
    assert {(r.word, r.next_word): r.n for r in entries.collect()} == dict(expected[0])
    per_word = s.groupBy("word").agg(F.count(F.lit(1)).alias("rows"), F.first("parts").alias("parts"))
    assert per_word.where("rows > parts").count() == 0
    probs = {(r.word, r.next_word): r.probability for r in B.bigram_probabilities_from_stripes(s).collect()}
    assert probs == expected[2]


def test_keyed_and_sorted(counts, expected):
    probs = B.bigram_probabilities(counts)
    keyed = {r.bigram: r.probability for r in B.keyed_probabilities(probs).collect()}
    assert keyed == {f"{w}-{x}": p for (w, x), p in expected[2].items()}
    rows = [(r.word, r.probability, r.next_word) for r in B.sort_probabilities(probs).collect()]
    assert rows == sorted(rows)


def test_next_words_order(counts, expected):
    rows = [(r.next_word, r.probability) for r in B.next_words(B.bigram_probabilities(counts), "the").collect()]
    want = sorted(((x, p) for (w, x), p in expected[2].items() if w == "the"), key=lambda t: (-t[1], t[0]))
    assert rows == want


def test_top_next_words(counts, expected):
    k = 3
    got = {(r.word, r.rank): r.next_word
           for r in B.top_next_words(B.bigram_probabilities(counts), k).collect()}
    by_word = defaultdict(list)
    for (w, x), p in expected[2].items():
        by_word[w].append((-p, x))
    want = {}
    for w, items in by_word.items():
        for i, (_, x) in enumerate(sorted(items)[:k]):
            want[(w, i + 1)] = x
    assert got == want


def test_top_next_words_from_counts(counts):
    a = {(r.word, r.rank): (r.next_word, r.probability)
         for r in B.top_next_words(B.bigram_probabilities(counts), 4).collect()}
    b = {(r.word, r.rank): (r.next_word, r.probability)
         for r in B.top_next_words_from_counts(counts, 4).collect()}
    assert a == b
