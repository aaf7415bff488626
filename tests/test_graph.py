"""Graph basics and PageRank (U1, A6-A11, F3-F5, J1-J4, G1-G5, T2, X1, X2,
X8, X11, X14): the survey's hand-checked fixture, a plain-Python loop on a
derived graph, invariants, and hub splitting."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bigraph.operators import graph as G
from bigraph.operators import pagerank as P
from bigraph.operators.ranking import top_n
from bigraph.sources import edges as table_edges

from .conftest import SF_SMALL


def ranks_of(df, digits=9):
    return {r.node: round(r.page_rank, digits) for r in df.collect()}


def python_pagerank(edge_list, rounds, damping=None, node_range=None, dedupe=False, tol=None):
    """Plain-Python statement of the rules, for checking."""
    if dedupe:
        edge_list = sorted(set(edge_list))
    nodes = sorted({u for e in edge_list for u in e})
    n = len(nodes)
    out = defaultdict(list)
    for s, d in edge_list:
        out[s].append(d)
    pr = {v: 1.0 / n for v in nodes}
    for _ in range(rounds):
        inc = defaultdict(float)
        for s, ds in out.items():
            for d in ds:
                inc[d] += pr[s] / len(ds)
        if damping is None:
            new = {v: inc.get(v, 0.0) for v in nodes}
        else:
            dm = sum(pr[v] for v in nodes if not out.get(v))
            new = {}
            for v in nodes:
                share = dm / n if node_range is None or node_range[0] <= v < node_range[1] else 0.0
                new[v] = (1 - damping) / n + damping * (share + inc.get(v, 0.0))
        err = sum(abs(new[v] - pr[v]) for v in nodes)
        pr = new
        if tol is not None and err < n * tol:
            break
    return pr


# ------------------------------------------------------------------ fixture

@pytest.mark.parametrize("rounds,want", [
    (0, [0.25, 0.25, 0.25, 0.25]),
    (1, [0.125, 0.125, 0.375, 0.125]),
    (2, [0.1875, 0.0625, 0.1875, 0.1875]),
])
def test_simple_fixture(small_graph, rounds, want):
    assert ranks_of(P.pagerank_simple(small_graph, rounds)) == dict(enumerate(want))


@pytest.mark.parametrize("rounds,want", [
    (1, [0.196875, 0.196875, 0.409375, 0.196875]),
    (2, [0.253320312, 0.163007812, 0.330351562, 0.253320312]),
    (50, [0.233993778, 0.186671033, 0.345341411, 0.233993778]),
])
def test_complete_fixture(small_graph, rounds, want):
    assert ranks_of(P.pagerank_complete(small_graph, rounds)) == dict(enumerate(want))


@pytest.mark.parametrize("rounds,want", [
    (1, [0.196875, 0.196875, 0.409375, 0.14375]),
    (2, [0.24203125, 0.15171875, 0.3190625, 0.211484375]),
])
def test_complete_node_range_fixture(small_graph, rounds, want):
    """Ids in [0, 3) get the dangling share, node 3 does not."""
    assert ranks_of(P.pagerank_complete(small_graph, rounds, node_range=(0, 3))) == dict(enumerate(want))


def test_duplicate_edge_weighs_twice(spark):
    e = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 2), (2, 0), (2, 3)], "src bigint, dst bigint")
    assert ranks_of(P.pagerank_simple(e, 1)) == {0: 0.125, 1: 0.166666667, 2: 0.333333333, 3: 0.125}


def test_no_dangling_graph(spark):
    """No dangling node: mass is 0.0, nothing fails."""
    e = spark.createDataFrame([(0, 1), (1, 0)], "src bigint, dst bigint")
    assert ranks_of(P.pagerank_complete(e, 5)) == {0: 0.5, 1: 0.5}
    assert P.dangling_mass(e, G.initial_ranks(e)).first()["dangling_mass"] == 0.0


def test_self_loop(spark):
    e = spark.createDataFrame([(0, 0), (0, 1)], "src bigint, dst bigint")
    assert ranks_of(P.pagerank_simple(e, 1)) == {0: 0.25, 1: 0.25}


def test_string_ids(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    assert ranks_of(P.pagerank_complete(e, 1)) == {"a": 0.196875, "b": 0.196875, "c": 0.409375, "d": 0.196875}


def test_one_step_operators(small_graph):
    r0 = G.initial_ranks(small_graph)
    assert ranks_of(r0) == {0: 0.25, 1: 0.25, 2: 0.25, 3: 0.25}
    inc = {r.node: r.incoming for r in P.rank_contributions(small_graph, r0).collect()}
    assert inc == {0: 0.125, 1: 0.125, 2: 0.375, 3: 0.125}
    assert P.dangling_mass(small_graph, r0).first()["dangling_mass"] == 0.25
    assert ranks_of(P.rank_step(small_graph, r0)) == {0: 0.196875, 1: 0.196875, 2: 0.409375, 3: 0.196875}
    assert ranks_of(P.rank_step(small_graph, r0, damping=None)) == {0: 0.125, 1: 0.125, 2: 0.375, 3: 0.125}


def test_graph_basics(small_graph):
    assert sorted(r.node for r in G.node_set(small_graph).collect()) == [0, 1, 2, 3]
    s = G.graph_stats(small_graph).first()
    assert (s.min_node, s.max_node, s.n_nodes) == (0, 3, 4)
    assert {r.node: r.out_degree for r in G.out_degrees(small_graph).collect()} == {0: 2, 1: 1, 2: 2, 3: 0}
    assert [r.node for r in G.dangling_nodes(small_graph).collect()] == [3]
    adj = {r.node: (sorted(r.out_links), r.page_rank) for r in G.adjacency(small_graph).collect()}
    assert adj == {0: ([1, 2], 0.25), 1: ([2], 0.25), 2: ([0, 3], 0.25), 3: ([], 0.25)}


def test_adjacency_hub_split(spark):
    e = spark.createDataFrame([(0, d) for d in range(1, 41)] + [(1, 0)], "src bigint, dst bigint")
    adj = G.adjacency(e, max_entries=10).cache()
    hub = adj.where("node = 0").collect()
    assert len(hub) > 1 and all(r.parts == 4 for r in hub)
    assert sorted(x for r in hub for x in r.out_links) == list(range(1, 41))
    assert adj.agg(F.sum("page_rank")).first()[0] == pytest.approx(1.0)


def test_top_n(small_graph):
    ranks = P.pagerank_complete(small_graph, 1)
    assert [r.node for r in top_n(ranks, 2).collect()] == [2, 0]  # tie 0/1/3 broken by node
    assert top_n(ranks, 100).count() == 4  # n over the row count returns all


# ------------------------------------------------------- derived test graph

@pytest.fixture(scope="module")
def derived(spark):
    e = table_edges(spark, SF_SMALL).cache()
    return e, [(r.src, r.dst) for r in e.collect()]


@pytest.mark.parametrize("damping", [None, 0.85])
def test_against_python_loop(derived, damping):
    e, edge_list = derived
    want = python_pagerank(edge_list, 10, damping)
    fn = P.pagerank_simple if damping is None else P.pagerank_complete
    got = {r.node: r.page_rank for r in fn(e, 10).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[v] - want[v]) for v in want) < 1e-15


def test_range_against_python_loop(derived):
    e, edge_list = derived
    s = G.graph_stats(e).first()
    want = python_pagerank(edge_list, 10, 0.85, node_range=(s.min_node, s.max_node))
    got = {r.node: r.page_rank for r in P.pagerank_complete(e, 10, node_range=(s.min_node, s.max_node)).collect()}
    assert max(abs(got[v] - want[v]) for v in want) < 1e-15
    assert sum(got.values()) < 1.0


def test_converged_against_python_loop(derived):
    e, edge_list = derived
    want = python_pagerank(edge_list, 50, 0.85, dedupe=True, tol=1e-6)
    got = {r.node: r.page_rank for r in P.pagerank_converged(e).collect()}
    assert max(abs(got[v] - want[v]) for v in want) < 1e-15


def test_not_converged_raises(derived):
    with pytest.raises(P.PageRankNotConverged):
        P.pagerank_converged(derived[0], max_iter=2)


def test_mass_invariants(derived):
    e, _ = derived
    assert P.rank_mass(P.pagerank_complete(e, 5)).first()["rank_mass"] == pytest.approx(1.0, abs=1e-12)
    masses = [P.rank_mass(P.pagerank_simple(e, k)).first()["rank_mass"] for k in range(4)]
    assert masses[0] == pytest.approx(1.0)
    assert all(b <= a + 1e-15 for a, b in zip(masses, masses[1:]))  # simplified mass never grows


def test_hub_split_same_result(derived):
    """Splitting sources with more than 2 out-links across salts changes no rank."""
    e, _ = derived
    plain = {r.node: r.page_rank for r in P.pagerank_complete(e, 5).collect()}
    split = {r.node: r.page_rank for r in P.pagerank_complete(e, 5, split_edges=2).collect()}
    assert max(abs(plain[v] - split[v]) for v in plain) < 1e-15


def test_zero_rounds(derived):
    e, edge_list = derived
    n = len({u for x in edge_list for u in x})
    assert set(ranks_of(P.pagerank_complete(e, 0), 15).values()) == {round(1.0 / n, 15)}


def test_given_node_count(small_graph):
    """``n_nodes`` is a parameter that overrides the count."""
    assert ranks_of(P.pagerank_simple(small_graph, 1, n_nodes=8)) == {0: 0.0625, 1: 0.0625, 2: 0.1875, 3: 0.0625}
    assert ranks_of(G.initial_ranks(small_graph, n_nodes=8)) == {0: 0.125, 1: 0.125, 2: 0.125, 3: 0.125}


def test_empty_graph(spark):
    e = spark.createDataFrame([], "src bigint, dst bigint")
    assert P.pagerank_complete(e, 3).count() == 0
    assert P.pagerank_converged(e).count() == 0
    assert G.adjacency(e).count() == 0 and G.initial_ranks(e).count() == 0
    assert P.rank_step(e, G.initial_ranks(e)).count() == 0
    assert G.graph_stats(e).first()["n_nodes"] == 0


# ------------------------------------------------- one job a round, restart, folders

def ring(spark, n=60):
    rows = [(i, (i * 7 + 1) % n) for i in range(n - 5)] + [(i, (i * 3 + 2) % n) for i in range(0, n - 5, 2)]
    return spark.createDataFrame(rows, "src bigint, dst bigint")


def test_metrics_come_with_the_round(spark):
    """Dangling mass, L1 change, rank sum and rows of each round, observed."""
    edges = ring(spark)
    g = P.prepare_graph(edges)
    state, n = P.iterate_ranks(g, 50, 0.85, tol=1e-6)
    ranks = state.select("node", "page_rank")
    assert n == len(g.rounds) > 3 and all(r["rows"] == g.n_nodes for r in g.rounds)
    assert abs(g.rounds[-1]["dangling_mass"] - P.dangling_mass(edges, ranks).first()[0]) < 1e-14
    assert abs(g.rounds[-1]["rank_mass"] - P.rank_mass(ranks).first()[0]) < 1e-14
    change = state.selectExpr("sum(abs(page_rank - previous))").first()[0]
    assert abs(g.rounds[-1]["l1_change"] - change) < 1e-14
    assert g.rounds[-2]["l1_change"] >= g.n_nodes * 1e-6 > change
    g.release()


def test_a_round_is_one_write(spark, monkeypatch):
    """No other action than the write runs in a round."""
    from pyspark.sql import DataFrame

    g = P.prepare_graph(ring(spark))
    def refuse(*_, **__):
        raise AssertionError("an action beside the write")
    for name in ("first", "collect", "count", "head", "take", "toPandas"):
        monkeypatch.setattr(type(g.layout), name, refuse)
    assert issubclass(type(g.layout), DataFrame)
    _, n = P.iterate_ranks(g, 50, 0.85, tol=1e-6)
    assert n > 3
    monkeypatch.undo()
    g.release()


@pytest.mark.parametrize("form", ["simple", "complete", "converged"])
def test_resume_equals_the_straight_run(spark, tmp_path, monkeypatch, form):
    """The driver stops after round 3; a second call with the folder goes on."""
    edges, path = ring(spark), f"file://{tmp_path}/run"
    run = {"simple": lambda **k: P.pagerank_simple(edges, 6, **k), "complete": lambda **k: P.pagerank_complete(edges, 6, **k),
           "converged": lambda **k: P.pagerank_converged(edges, **k)}[form]
    want = {r.node: r.page_rank for r in run().collect()}
    whole, calls = P._round, []

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) == 4:
            raise KeyboardInterrupt
        return whole(*args, **kw)

    monkeypatch.setattr(P, "_round", dies)
    with pytest.raises(KeyboardInterrupt):
        run(run_dir=path)
    got = {r.node: r.page_rank for r in run(run_dir=path).collect()}
    assert max(abs(got[v] - want[v]) for v in want) < 1e-15 and got.keys() == want.keys()
    monkeypatch.setattr(P, "_round", None)           # all rounds are there: none is run
    again = {r.node: r.page_rank for r in run(run_dir=path).collect()}
    assert again == got
    with pytest.raises(ValueError, match="other settings"):
        P.pagerank_complete(edges, 9, damping=0.5, run_dir=path)


def test_close_removes_what_operators_wrote(spark):
    import os

    from bigraph import session

    folder = session.checkpoint_dir(spark).removeprefix("file:")
    session.close(spark)
    before = set(os.listdir(folder))
    ranks = P.pagerank_complete(ring(spark), 4)
    assert ranks.count() == 60 and set(os.listdir(folder)) > before
    assert session.close(spark) >= 3        # the run, and the checkpoints of layout and nodes
    assert set(os.listdir(folder)) == before and session.close(spark) == 0


# ------------------------------------------------- nodes without out-links in one row

def fan(n=40, ends=60):
    """More ends than other nodes; copies of edges, also to ends; an end on either side of every id range."""
    rows = [(i, (i * 7 + 1) % n) for i in range(n)] + [(i % n, 100 + i) for i in range(ends)] + [(3, 100)] * 4
    return rows + [(i, -1 - i) for i in range(0, n, 5)]


@pytest.mark.parametrize("damping, node_range, split", [(None, None, 1000), (0.85, None, 2), (0.85, (-3, 120), 1000)])
def test_rounds_before_the_last_hold_ends_in_one_row(spark, damping, node_range, split):
    rows = fan()
    g = P.prepare_graph(spark.createDataFrame(rows, "src bigint, dst bigint"), split_edges=split, mark_tails=True)
    state, _ = P.iterate_ranks(g, 7, damping, node_range=node_range)
    want = python_pagerank(rows, 7, damping, node_range=node_range)
    got = {r.node: r.page_rank for r in state.collect()}
    assert got.keys() == want.keys() and max(abs(got[v] - want[v]) for v in want) < 1e-15
    assert [r["rows"] for r in g.rounds] == [g.n_nodes - g.n_dangling + 1] * 6 + [g.n_nodes]
    for i, r in enumerate(g.rounds):       # the one row is their rank, all of it
        full = python_pagerank(rows, i + 1, damping, node_range=node_range)
        assert r["dangling_mass"] == pytest.approx(sum(full[v] for v in full if v < 0 or v >= 100), abs=1e-15)
        assert r["rank_mass"] == pytest.approx(sum(full.values()), abs=1e-14)
    g.release()


def test_cut_run_ends_at_the_round_it_had_reached(spark, tmp_path, monkeypatch):
    """A run for 6 rounds is cut after the third and called again for 3, then for 5."""
    rows, path = fan(), f"file://{tmp_path}/run"
    edges, whole, calls = spark.createDataFrame(rows, "src bigint, dst bigint"), P._round, []

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) == 4:
            raise KeyboardInterrupt
        return whole(*args, **kw)

    monkeypatch.setattr(P, "_round", dies)
    with pytest.raises(KeyboardInterrupt):
        P.pagerank_complete(edges, 6, run_dir=path)
    monkeypatch.setattr(P, "_round", whole)
    for rounds in (3, 5):
        want = python_pagerank(rows, rounds, 0.85)
        got = {r.node: r.page_rank for r in P.pagerank_complete(edges, rounds, run_dir=path).collect()}
        assert got.keys() == want.keys() and max(abs(got[v] - want[v]) for v in want) < 1e-15


def test_a_round_reads_the_edges_in_place_and_in_order(spark):
    """No exchange or sort on the layout."""
    g = P.prepare_graph(spark.createDataFrame(fan(), "src bigint, dst bigint"), split_edges=2, mark_tails=True)
    plan = P._round(g, P._initial_state(g, g.n_nodes), g.n_nodes, None, None, 0.0)._jdf.queryExecution().executedPlan().toString()
    head = plan.split("SortMergeJoin")[1].split("InMemoryTableScan")[0]
    assert "Exchange" not in head and "Sort" not in head
    g.release()


def test_text_ids_iterate_as_fingerprints(spark, monkeypatch):
    """Rounds hold 64-bit numbers, results the ids; two nodes of one fingerprint keep their texts."""
    rows = [(f"node {a}", f"node {b}") for a, b in fan()]
    edges, want = spark.createDataFrame(rows, "src string, dst string"), python_pagerank(rows, 4, 0.85)
    g = P.prepare_graph(edges)
    assert dict(g.layout.dtypes)["src"] == dict(g.layout.dtypes)["dst"] == "bigint"
    g.release()
    for print_of in (P._fingerprint, lambda c: F.length(c).cast("bigint")):
        monkeypatch.setattr(P, "_fingerprint", print_of)
        got = {r.node: r.page_rank for r in P.pagerank_complete(edges, 4).collect()}
        assert got.keys() == want.keys() and max(abs(got[v] - want[v]) for v in want) < 1e-15
    assert dict(P.pagerank_complete(edges, 2, node_range=("node 1", "node 2")).dtypes)["node"] == "string"
