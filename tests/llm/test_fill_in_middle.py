"""Fill-in-the-middle against a plain-Python statement."""

import hashlib
import re

import numpy as np
import pytest

from bigraph.llm import fill_in_middle as fim
from bigraph.llm.queries import QUERIES

from .conftest import pairs

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def transform(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    x = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def expected(rows):
    out = []
    for d, t in rows:
        *head, output = transform(d, t)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((d, *head, sha(output), sha(t or "")))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_equals_plain_statement(spark, documents, sf):
    assert got(QUERIES["op13_fill_in_middle"](spark, sf)) == expected(pairs(documents))


def tricky(spark):
    """Marks, halves of marks, scripts, controls, a long text, copies."""
    texts = ["<P>", "a<S>b", "x <M", "P> <", "<<<P", "S>>", "<p> <Q>", "ab12cd", "é", "áb", "\U0001f600x\U0001f600",
             "\n\r\t\x00", "<P", "<" * 50, "漢字 kana かな", "word " * 40_000, "", None, "Z"]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(None, "no id"), (None, None), (5, "twice"), (5, "twice")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("units", [1, 3, 1024])
def test_pieces_of_any_size(spark, units):
    df = tricky(spark).where("text is null or length(text) < 1000") if units < 9 else tricky(spark)
    assert got(fim.digests(fim.output_pieces(df, piece_units=units))) == expected(pairs(df))


def test_outputs(spark):
    df = tricky(spark)
    want = sorted(((d, *transform(d, t)) for d, t in pairs(df)), key=str)
    assert sorted((tuple(r) for r in fim.outputs(fim.output_pieces(df)).collect()), key=str) == want


def test_restorer_with_marks_cut_anywhere():
    out = b"<S>tail<<P>head<P<M>mid<"
    for step in (1, 2, 3, 5, 100):
        r, parts = fim.Restorer("spm"), {0: b"", 1: b"", 2: b""}
        for i in range(0, len(out), step):
            for k, piece in r.feed(out[i:i + step]):
                parts[k] += piece
        for k, piece in r.end():
            parts[k] += piece
        assert parts == {0: b"head<P", 1: b"mid<", 2: b"tail<"}


def test_one_shuffle(spark, documents):
    """The restoration is sorted inside the partitions of the outputs."""
    plan = fim.digests(fim.output_pieces(documents))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 3


def test_copies_of_a_row_spread(spark):
    """A third of all rows are one document: no partition holds them all."""
    df = spark.createDataFrame([(1, "same text")] * 600 + [(i, f"other {i}") for i in range(2, 1200)],
                               "doc_id bigint, text string")
    sizes = [len(p) for p in fim.output_pieces(df).where("key = 1").rdd.glom().collect()]
    assert sum(sizes) == 600 and max(sizes) < 300


def test_odd_rows(odd, none):
    assert got(fim.digests(fim.output_pieces(odd))) == expected(pairs(odd))
    assert fim.digests(fim.output_pieces(none)).collect() == []


def test_units():
    data = np.frombuffer("ab1é cd".encode(), np.uint8)
    assert fim.unit_starts(data, np.array([0, 1, data.size])).tolist() == [0, 1, 2, 3, 5, 6]
