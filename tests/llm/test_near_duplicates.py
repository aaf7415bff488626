import random

import numpy as np
import pytest

from bigraph.llm import minhash_bayes
from bigraph.llm.components import components
from bigraph.llm.minhash_bayes import keep_first, least_matches, minhash, near_duplicates

from . import brute
from .conftest import pairs


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force(documents):
    assert got(near_duplicates(documents)) == brute.near_duplicates(pairs(documents))


def test_large_group_of_near_copies(spark):
    """Copies near the threshold: many meet neither end of their bucket above
    it, and still every component is found; exact copies are a class."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for k in r.sample(range(120), r.randrange(0, 4)):
            words[k] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[5][1].upper()) for i in range(300)] + [(2000 + i, f"lone text number {i} of some words") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got(near_duplicates(df)) == brute.near_duplicates(rows)


def test_odd_rows(odd):
    rows = sorted(near_duplicates(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == odd.count()
    assert by[1][0].component_id == 1 and by[1][0].kept
    assert [r.component_id for r in by[2]].count(1) == 2 and sum(r.kept for r in by[2]) == 1
    assert (by[3][0].n_shingles, by[3][0].kept) == (0, True) and (by[5][0].n_shingles, by[5][0].kept) == (0, True)
    assert sorted(r.n_shingles for r in by[None]) == [0, 36]
    assert by[9][0].component_id == 8 and by[8][0].n_shingles == 1
    assert by[7][0].component_id == 6
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.kept for r in rows)


def test_empty_table(none):
    assert near_duplicates(none).collect() == [] and keep_first(none).collect() == []


def test_sequential_test_bounds():
    """A pair at the threshold is dropped with about the chosen probability."""
    need = least_matches(0.85, 1e-5)
    assert list(need) == sorted(need) and need[-1] < 0.85 * 120
    r = np.random.default_rng(1)
    equal = (r.random((20_000, 6, 20)) < 0.85).sum(axis=2).cumsum(axis=1)
    assert (equal < need).any(axis=1).mean() < 1e-3


def test_minhash_estimates_similarity():
    a = np.sort(np.random.default_rng(2).integers(0, 1 << 50, 2000).astype(np.uint64))
    b = np.sort(np.concatenate([a[:1600], np.random.default_rng(3).integers(0, 1 << 50, 400).astype(np.uint64)]))
    s = minhash(np.concatenate([a, b]), np.array([2000, 2000]))
    assert abs((s[0] == s[1]).mean() - 1600 / 2400) < 0.15


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    r = random.Random(5)
    links = {"chain": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(300)],
             "random": [(r.randrange(300), r.randrange(300)) for _ in range(200)]}[shape]
    want = brute.union_find({x for l in links for x in l}, links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: c for x, c in want.items() if any(a != b and x in (a, b) for a, b in links)}


def test_blocks_of_a_hot_bucket_run_in_several_tasks(spark):
    """All members of one bucket, in pairs of components: the blocks are dealt
    over tasks, and full sets travel for members that pass the tests only."""
    import re

    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 4000
        multi = spark.range(n).select(F.lit(7).cast("bigint").alias("bucket"), F.col("id").alias("key"))
        comps = spark.range(n).select(F.col("id").alias("node"), (F.col("id") - F.col("id") % 2).alias("component"))
        rows, _ = minhash_bayes._blocks(multi, comps)
        dealt = rows.repartition(*minhash_bayes._BLOCK_KEY)
        per_task = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        blocks = dealt.select(*minhash_bayes._BLOCK_KEY).distinct().count()
        assert blocks == 64 and len(per_task) >= 5 and max(per_task) < sum(per_task) / 3
        # Every seeker meets every member in exactly one block.
        met = (rows.where("role = 0").select("bucket", "sb", "mb", F.col("key").alias("s"))
               .join(rows.where("role = 1").select("bucket", "sb", "mb", F.col("key").alias("m")), ["bucket", "sb", "mb"]))
        assert met.where("s in (5, 17)").count() == 2 * n and met.where("s in (5, 17)").distinct().count() == 2 * n
        plan = (dealt.groupBy(*minhash_bayes._BLOCK_KEY).applyInArrow(lambda _, t: t, rows.schema)
                ._jdf.queryExecution().executedPlan().toString())
        assert re.search(r"hashpartitioning\(bucket#\d+L, sb#\d+, mb#\d+, \d+\)", plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled") if old is None else spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.enabled", old)


def test_rounds_of_few_links_write_few_files(spark, monkeypatch):
    """The files of a round follow its links, not the shuffle partitions."""
    from bigraph.llm import components as module

    files = []

    def written(df, tag, **kw):
        out = materialize(df, tag, **kw)
        files.append((tag, len(out.inputFiles())))
        return out

    materialize = module.materialize
    monkeypatch.setattr(module, "materialize", written)
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        links = [(i, i + 1) for i in range(300)] + [(1000 + i, 2000 + i) for i in range(300)]
        df = spark.createDataFrame(links, "a bigint, b bigint")
        found = {r.node: r.component for r in components(df, most=len(links)).collect()}
        assert len(found) == 901 and found[300] == 0 and found[2299] == 1299
        assert len(files) > 3 and max(n for _, n in files) == 1, files
        # More rows than one file takes: as many files as that makes.
        monkeypatch.setattr("bigraph.llm.common.FILE_ROWS", 100)
        files.clear()
        assert {r.node: r.component for r in components(df, most=len(links)).collect()} == found
        assert all(1 < n <= 6 for _, n in files), files
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
