"""Importance resampling against a plain-Python statement."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bigraph.llm import importance_bitslice as ib
from bigraph.llm.queries import QUERIES

from .brute import LOWER
from .conftest import pairs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text, max_run):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i:i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(x.encode()) for x in runs]


def resample(rows, target, buckets=10_000, max_run=1, min_words=20, percent=10):
    bags = [(d, *bag(t, max_run)) for d, t in rows]
    s = Counter(c % buckets for _, _, b in bags for c in b)
    t = Counter(c % buckets for x in target for c in bag(x, max_run)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * float(ns + buckets) / ((s[b] + 1) * float(nt + buckets))))
            for b in range(buckets)}
    out = []
    for d, words, b in bags:
        weight = sum(gain[c % buckets] for c in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = {id(r): i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_plain_statement(spark, documents, sf):
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = got(QUERIES["op12_importance_bitslice"](spark, sf))
    assert rows == resample(pairs(documents), target)
    assert sum(r[4] is not None for r in rows) > 10


@pytest.mark.parametrize("buckets,max_run,percent", [(64, 1, 50), (1000, 2, 10), (77, 3, 100)])
def test_other_settings(spark, documents, buckets, max_run, percent):
    target = spark.createDataFrame([("the and of the",), (None,), ("é漢字 x2 " * 30,)], "text string")
    rows = got(ib.resampled(documents, target, buckets=buckets, max_run=max_run, draw_percent=percent, min_words=3))
    assert rows == resample(pairs(documents), [r.text for r in target.collect()], buckets, max_run, 3, percent)


def test_odd_rows(spark, odd, none):
    target = spark.createDataFrame([("word1 word2 tie3",)], "text string")
    want = resample(pairs(odd), ["word1 word2 tie3"], min_words=1, percent=50)
    rows = got(ib.resampled(odd, target, min_words=1, draw_percent=50))
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    assert sorted(r[4] for r in rows if r[4]) == sorted(r[4] for r in want if r[4])
    assert got(ib.resampled(odd, none.select("text"))) and got(ib.resampled(none, target)) == []


def test_equal_rows_rank_over_several_partitions(spark):
    """A third of the rows are one row: ranks are whole, and no range
    partition takes them all."""
    df = spark.createDataFrame([(7, "same words here")] * 400 + [(i, f"other {i}") for i in range(100, 900)],
                               "doc_id bigint, text string")
    rows = ib.resampled(df, df.limit(1).select("text"), min_words=1, draw_percent=100)
    assert sorted(r["rank"] for r in rows.collect()) == list(range(1, 1201))


def test_planes_hold_the_counts():
    rng = np.random.default_rng(3)
    doc, bucket = rng.integers(0, 9, 5000), rng.zipf(1.3, 5000) % 200
    doc[doc == 4] = 5                                   # a document without features
    planes, depth = ib.count_planes(doc, bucket, 9, 200)
    bits = np.unpackbits(planes, axis=1, bitorder="little")[:, :200].astype(np.int64)
    first = np.cumsum(depth) - depth
    gains = rng.integers(-20_000, 9_000, 200)
    sums = ib.gain_sums(planes, depth, ib.gain_planes(gains))
    for d in range(9):
        want = np.bincount(bucket[doc == d], minlength=200)
        mine = bits[first[d]:first[d] + depth[d]]
        assert ((mine << np.arange(depth[d])[:, None]).sum(axis=0) == want).all()
        assert sums[d] == (want * gains).sum()


def test_crc_of_spans():
    data = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    starts = np.array([0, 5, 5, 100, 255, 0, 300])
    ends = np.array([0, 6, 53, 149, 256, 700, 303])
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert ib.span_crc32(data, starts, ends).tolist() == want
