import hashlib
import random

import pytest

from bigraph.llm.suffix_pfp import removal_digest, without_repeats

from . import brute
from .conftest import pairs


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.fixture(scope="module")
def made():
    """Passages cut from one text at many places, periodic texts, texts at
    the limit, and multi-byte characters."""
    r = random.Random(5)
    base = "".join(r.choice("abcdefgh éß") for _ in range(3000))
    rows = []
    for i in range(300):
        a = r.randrange(2500)
        rows.append((i, "".join(r.choice("xyz ") for _ in range(r.randrange(60))) + base[a:a + r.randrange(20, 400)]
                     + r.choice(["", "q", "zz " * 50, base[:120]])))
    return rows + [(500, None), (501, ""), (502, "a" * 1000), (503, "ab" * 300), (504, "a" * 99), (505, "a" * 100),
                   (506, "a" * 100 + "b" * 99), (507, "漢" * 200)]


@pytest.mark.parametrize("settings", [{}, {"hot_rows": 3, "max_rows": 50}, {"segment": 150}])
def test_matches_brute_force(spark, made, settings):
    """Also with limits so small that triggers are split and handed on, and
    that most documents are parsed in segments."""
    df = spark.createDataFrame(made, "doc_id bigint, text string").repartition(4)
    assert got(removal_digest(df, **settings)) == brute.remove_repeats(made)


def test_documents(documents):
    assert got(removal_digest(documents)) == brute.remove_repeats(pairs(documents))


def test_odd_rows(odd):
    rows = removal_digest(odd).collect()
    assert len(rows) == odd.count()
    ties = sorted((r for r in rows if r.n_bytes == len(" ".join(f"tie{i}" for i in range(40)))), key=lambda r: r.n_removed)
    assert [r.n_removed > 0 for r in ties] == [False, True, True, True]
    assert {r.kept_sha256 for r in rows if r.n_bytes == 0} == {hashlib.sha256(b"").hexdigest()}
    cut = without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert sum(r.text is None for r in cut.collect()) == 2


def test_empty_table(none):
    assert removal_digest(none).collect() == [] and without_repeats(none).collect() == []
