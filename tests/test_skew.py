"""A hot key (a third or more of all rows) is split, not sent to one task.

Adaptive execution's thresholds are lowered to test scale so its skew
handling can be seen on small data."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bigraph.functions import hot_keys
from bigraph.operators import bigrams as B
from bigraph.operators import graph as G
from bigraph.operators import pagerank as P

from .test_text import reference_pairs

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def letters(k):
    """A letter-only word for an integer (digits would split words)."""
    out = ""
    while True:
        k, r = divmod(k, 26)
        out = "abcdefghijklmnopqrstuvwxyz"[r] + out
        if k == 0:
            return "w" + out


@pytest.fixture(scope="module")
def hot_docs(spark):
    """Every other word is "the": half of all distinct bigrams start with it."""
    texts = [" ".join(f"the {letters(d * 1000 + i)}" for i in range(200)) for d in range(20)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8), texts


def want_probabilities(texts):
    pairs = Counter(p for t in texts for p in reference_pairs(t))
    totals = defaultdict(int)
    for (w, _), n in pairs.items():
        totals[w] += n
    return {(w, x): n / totals[w] for (w, x), n in pairs.items()}


def most_in_a_task(df, where):
    """Rows of a key in the fullest task of the final stage."""
    return (df.where(where).groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0])


@pytest.mark.parametrize("threshold", ["-1", "200k"])
def test_hot_word_is_spread_over_the_join(spark, skew_conf, hot_docs, threshold):
    """With a limit of 500 followers, "the" (4000 followers) takes its total
    from the bounded table and its rows are spread, whatever Spark's own
    broadcast threshold; the result is exact."""
    docs, texts = hot_docs
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, threshold)
    counts = B.bigram_counts(B.bigrams(docs)).cache()
    probs = B.bigram_probabilities(counts, max_entries=500)
    assert {(r.word, r.next_word): r.probability for r in probs.collect()} == want_probabilities(texts)
    assert "BroadcastHashJoin" in probs._jdf.queryExecution().executedPlan().toString()
    assert most_in_a_task(probs, "word = 'the'") <= 1000
    s = B.stripes(counts, max_entries=500)
    assert most_in_a_task(s.select("word", F.explode("stripe")), "word = 'the'") <= 2 * 1000
    counts.unpersist()


@pytest.mark.parametrize("threshold", ["-1", "200k"])
def test_hub_is_spread(spark, skew_conf, threshold):
    """A node with a third of all links: adjacency parts and PageRank salts
    spread it at any broadcast threshold."""
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, threshold)
    edges = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 4000 + 1).cast("bigint").alias("src"),
        (F.col("id") + 1).alias("dst"))
    adj = G.adjacency(edges, max_entries=500)
    assert most_in_a_task(adj.select("node", F.explode("out_links")), "node = 0") <= 2000
    assert adj.where("node = 0").agg(F.sum(F.size("out_links"))).first()[0] == 4000
    g = P.prepare_graph(edges, split_edges=500, partitions=8)
    assert most_in_a_task(g.layout, "src = 0") <= 2000
    g.release()


def test_hot_key_table_is_bounded(spark):
    """The table of hot keys keeps the largest ones, up to its bound."""
    sizes = spark.createDataFrame([(k, k) for k in range(100)], "word bigint, n bigint")
    kept = {r.word for r in hot_keys(sizes, "n", "word", 10, max_keys=5).collect()}
    assert kept == {95, 96, 97, 98, 99}


def test_exact_under_aggressive_adaptive_settings(spark, skew_conf, hot_docs):
    """With broadcasts off and skew thresholds at test scale (adaptive
    execution free to re-plan every join), the result keeps every bigram."""
    docs, texts = hot_docs
    probs = B.bigram_probabilities(B.bigram_counts(B.bigrams(docs)))
    pairs = Counter(p for t in texts for p in reference_pairs(t))
    assert probs.count() == len(pairs)


def test_hot_word_stripes_and_top_k(spark, hot_docs):
    docs, _ = hot_docs
    counts = B.bigram_counts(B.bigrams(docs)).cache()
    s = B.stripes(counts, max_entries=500).cache()
    hot = s.where("word = 'the'").collect()
    assert len(hot) == 8 and max(len(r.stripe) for r in hot) < 1000  # 4000 followers in 8 parts
    a = {(r.word, r.next_word): r.probability for r in B.bigram_probabilities(counts).collect()}
    b = {(r.word, r.next_word): r.probability for r in B.bigram_probabilities_from_stripes(s).collect()}
    assert a == b
    top = B.top_next_words(B.bigram_probabilities(counts), 3).where("word = 'the'").collect()
    assert [r.next_word for r in sorted(top, key=lambda r: r.rank)] == sorted(x for (w, x) in a if w == "the")[:3]


def test_out_hub_split(spark):
    """A node holding a third of all edges is spread over several salts."""
    edges = spark.createDataFrame([(0, d) for d in range(1, 301)] + [(d, (d * 7) % 300 + 1) for d in range(1, 601)],
                                  "src bigint, dst bigint")
    g = P.prepare_graph(edges, split_edges=50)
    salts = g.layout.where("src = 0").select("salt").distinct().count()
    assert salts == 6
    per_task = g.layout.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert per_task < 300
    g.release()
    a = {r.node: r.page_rank for r in P.pagerank_complete(edges, 5).collect()}
    b = {r.node: r.page_rank for r in P.pagerank_complete(edges, 5, split_edges=50).collect()}
    assert max(abs(a[v] - b[v]) for v in a) < 1e-15


def test_one_step_hub_split(spark):
    edges = spark.createDataFrame([(0, d) for d in range(1, 301)] + [(d, 0) for d in range(1, 301)],
                                  "src bigint, dst bigint")
    from bigraph.operators import graph as G
    r0 = G.initial_ranks(edges)
    a = {r.node: r.incoming for r in P.rank_contributions(edges, r0).collect()}
    b = {r.node: r.incoming for r in P.rank_contributions(edges, r0, split_edges=40).collect()}
    assert a.keys() == b.keys() and max(abs(a[v] - b[v]) for v in a) < 1e-15
    assert abs(a[0] - 300 / 301) < 1e-12


def test_copies_of_one_edge(spark):
    """A third of all rows are copies of one edge: they become one layout row
    carrying their number, and every copy still weighs once."""
    from .test_graph import python_pagerank

    edge_list = [(0, 1)] * 400 + [(0, 2), (1, 2), (2, 0), (2, 3)] + [(d, d + 1) for d in range(3, 800)]
    edges = spark.createDataFrame(edge_list, "src bigint, dst bigint")
    g = P.prepare_graph(edges)
    assert g.layout.where("src = 0 AND dst = 1").collect()[0]["mult"] == 400
    assert g.layout.count() == len(set(edge_list))
    g.release()
    want = python_pagerank(edge_list, 5, 0.85)
    got = {r.node: r.page_rank for r in P.pagerank_complete(edges, 5).collect()}
    assert max(abs(got[v] - want[v]) for v in want) < 1e-15
    inc = {r.node: r.incoming for r in P.rank_contributions(edges, G.initial_ranks(edges)).collect()}
    assert abs(inc[1] - (1 / 801) * 400 / 401) < 1e-15


def test_adjacency_copies_are_chunked(spark):
    from collections import Counter as C

    edge_list = [(0, 1)] * 25 + [(0, d) for d in range(2, 12)] + [(5, 0)]
    edges = spark.createDataFrame(edge_list, "src bigint, dst bigint")
    rows = G.adjacency(edges, max_entries=10).where("node = 0").collect()
    assert all(r.parts == 4 for r in rows)
    assert C(x for r in rows for x in r.out_links) == C(d for s, d in edge_list if s == 0)
    # copies of one link are cut into chunks of at most 10 that hash to parts
    # independently: the 25 copies do not stay together
    assert max(r.out_links.count(1) for r in rows) < 25
    assert [r.page_rank is not None for r in sorted(rows, key=lambda r: r.part)][0]
    assert sum(r.page_rank for r in rows if r.page_rank is not None) == 1 / 12


def test_top_k_is_limited_before_the_shuffle(spark, hot_docs):
    """One exchange on ``word``, with the group limit below it."""
    docs, _ = hot_docs
    counts = B.bigram_counts(B.bigrams(docs))
    plan = B.top_next_words_from_counts(counts, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "REPARTITION_BY_COL" not in plan


def test_top_n_at_tiny_ranks(spark):
    """Ranks far under any fixed number of decimals keep their order."""
    from bigraph.operators.ranking import significant, top_n

    ranks = spark.createDataFrame([(1, 1e-13), (2, 4e-13), (3, 3e-13), (4, 0.0)], "node bigint, page_rank double")
    assert [r.node for r in top_n(ranks, 2, significant("page_rank")).collect()] == [2, 3]
