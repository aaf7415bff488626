"""Executed plans: what is read, tokenised and shuffled once stays so, with
and without broadcasts; hot keys do not shape results."""

import re

import pytest
from pyspark.sql import functions as F

from bigraph.operators import bigrams as B
from bigraph.operators import graph as G
from bigraph.operators import pagerank as P
from bigraph.plans import QUERIES
from bigraph.sources import tables as T

from .conftest import SF_SMALL
from .test_skew import hot_docs, most_in_a_task  # noqa: F401


@pytest.fixture(params=["10MB", "-1"])
def broadcasts(spark, request):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, request.param)
    yield request.param
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """The final plan of a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(plan, *columns):
    """Exchanges on columns of these names that are not taken from another."""
    on = r"Exchange hashpartitioning\(" + ", ".join(rf"{c}#\d+L?" for c in columns) + r", \d+\)"
    return sum(bool(re.search(on, line)) and "ReusedExchange" not in line for line in plan.split("\n"))


@pytest.mark.parametrize("name", ["bigram_probabilities", "bigram_probabilities_split", "keyed_probabilities",
                                  "sort_probabilities", "next_words", "top_next_words", "stripes", "stripes_split",
                                  "bigram_probabilities_from_stripes"])
def test_corpus_is_tokenised_and_shuffled_once(spark, broadcasts, name):
    plan = executed(QUERIES[name](spark, SF_SMALL))
    assert plan.count("Generate inline") == 1 and plan.count("FileScan") == 1
    assert exchanges(plan, "word", "next_word") == 1


@pytest.mark.parametrize("name", ["parse_edges_text", "bigram_counts"])
def test_a_counting_task_does_not_grow_with_the_table(spark, monkeypatch, name):
    """What a task counts before the shuffle is bounded: a larger table has more tasks."""
    want = QUERIES[name](spark, SF_SMALL).count()
    size = T._file_bytes(spark, f"{SF_SMALL}/documents.parquet")
    assert size > 100_000
    monkeypatch.setattr(T, "TASK_BYTES", size // 40)
    df = QUERIES[name](spark, SF_SMALL)
    plan = executed(df)
    assert int(re.search(r"RoundRobinPartitioning\((\d+)\)", plan)[1]) >= 40
    assert df.count() == want
    monkeypatch.setattr(T, "TASK_BYTES", size)
    assert "RoundRobinPartitioning(40)" not in executed(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["rank_step", "rank_contributions", "rank_contributions_split", "adjacency",
                                  "adjacency_split", "initial_ranks", "dangling_mass", "parse_ranks"])
def test_edges_are_read_once(spark, broadcasts, name):
    """The window that derives the edges runs once, and the edges are shuffled
    on their ends once."""
    plan = executed(QUERIES[name](spark, SF_SMALL))
    assert len(re.findall(r"[^a-zA-Z]Window \[", plan)) == 1 and plan.count("FileScan") == 1
    assert exchanges(plan, "src", "dst") == (name != "initial_ranks")


def test_hot_word_is_spread_by_the_join_itself(spark, hot_docs):  # noqa: F811
    """Without adaptive execution: the salt is a key of the join."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        counts = B.bigram_counts(B.bigrams(hot_docs[0]))
        assert most_in_a_task(B.bigram_probabilities(counts, max_entries=500), "word = 'the'") <= 1000
        plan = B.bigram_probabilities(counts, max_entries=500)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[word#\d+, _salt#\d+\]", plan)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("max_keys", [1, 5])
def test_bound_of_the_hot_table_does_not_shape_results(spark, hot_docs, max_keys):  # noqa: F811
    """Far more keys to cut than the broadcast table may hold."""
    counts = B.bigram_counts(B.bigrams(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))).cache()

    def rows(df):
        return sorted(tuple(map(str, r)) for r in df.collect())

    want = B.stripes(counts, 20)
    assert want.where("parts > 1").select("word").distinct().count() > 50
    flat = [F.map_keys("stripe").alias("k")]
    cut = lambda df: rows(df.select("word", "part", "parts", "total", F.array_sort(flat[0]).alias("k")))
    assert cut(B.stripes(counts, 20, max_keys)) == cut(want)
    assert rows(B.bigram_probabilities(counts, 20, max_keys)) == rows(B.bigram_probabilities(counts))
    counts.unpersist()
    edges = spark.range(3000).select((F.col("id") % 97).alias("src"), (F.col("id") * 7 % 1000).alias("dst"))
    lists = lambda df: rows(df.select("node", "part", "parts", F.array_sort("out_links").alias("l"), "page_rank"))
    assert G.adjacency(edges, max_entries=4).where("parts > 1").select("node").distinct().count() > 50
    assert lists(G.adjacency(edges, max_entries=4, max_keys=max_keys)) == lists(G.adjacency(edges, max_entries=4))


def test_null_ends_are_no_edges(spark):
    rows = [(0, 1), (None, 2), (1, None), (None, None), (1, 0), (0, 1)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    assert {(r.node, r.out_degree) for r in G.out_degrees(edges).collect()} == {(0, 2), (1, 1)}
    assert {r.node for r in G.node_set(edges).collect()} == {0, 1}
    assert {(r.node, tuple(r.out_links)) for r in G.adjacency(edges).collect()} == {(0, (1, 1)), (1, (0,))}
    step = {r.node: r.page_rank for r in P.rank_step(edges, G.initial_ranks(edges)).collect()}
    assert step == {0: 0.5, 1: 0.5}
    pairs = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "word string, next_word string")
    assert [tuple(r) for r in B.bigram_counts(pairs).collect()] == [("a", "b", 1)]


def test_weighted_edges_give_the_same(spark):
    """Operators take edges with their copies counted."""
    edges = spark.createDataFrame([(0, 1)] * 3 + [(0, 2), (2, 0)], "src bigint, dst bigint")
    w = G.weighted_edges(edges)
    for f in (G.out_degrees, G.node_set, G.dangling_nodes, G.initial_ranks):
        assert sorted(map(tuple, f(w).collect())) == sorted(map(tuple, f(edges).collect()))
    ranks = G.initial_ranks(edges)
    assert sorted(map(tuple, P.rank_step(w, ranks).collect())) == sorted(map(tuple, P.rank_step(edges, ranks).collect()))
    a, b = ({(r.node, tuple(sorted(r.out_links))) for r in G.adjacency(x).collect()} for x in (w, edges))
    assert a == b


def test_stripes_run_no_lambda_to_sort_or_to_total(spark):
    plan = executed(QUERIES["stripes"](spark, SF_SMALL))
    assert "sort_array(" in plan and "array_sort(" not in plan and "aggregate(map_values" not in plan
