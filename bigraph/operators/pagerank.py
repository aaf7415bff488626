"""PageRank over an edge list ``src, dst``: one step, simplified (no damping),
complete (damping + dangling mass), and run to convergence.

Rules (with ``n`` nodes, ``S(v)`` the sum of ``PR(u) / outdeg(u)`` over the
edges ``u -> v``, ``D`` the rank held by dangling nodes):

* start: ``PR(v) = 1 / n`` for every node (targets included);
* simplified: ``PR'(v) = S(v)``; the rank of dangling nodes is lost and a
  node without in-links gets 0;
* complete: ``PR'(v) = (1 - d) / n + d * (D / n + S(v))``; with
  ``node_range=(lo, hi)`` only ids in ``[lo, hi)`` receive ``D / n`` (this
  reproduces runs that hand the dangling share to an id range);
* duplicate edges weigh twice and self-loops count, unless
  ``dedupe_edges=True``.

Physical design of the loop
---------------------------
* Copies of an edge are combined map-side into one row with their number
  ``mult`` (a group of copies is never a hot key), and the shares are
  multiplied by it, so copies still weigh once each.
* The edge list is laid out once: every edge gets a ``salt`` in
  ``[0, splits(src))`` from a hash of ``dst``, where ``splits`` grows with the
  number of distinct targets (``ceil(links / split_edges)``), and the edges are
  hash-partitioned on ``(src, salt)`` into partitions of about
  ``edges_per_partition`` edges and cached.  The salted edges are checkpointed
  in the shared folder: an executor that is lost costs its part of the layout,
  which comes from there again.  A
  hub's edges are spread over many tasks; the table of hubs is broadcast while
  laying out and cut at ``MAX_HOT_KEYS`` rows.
* The state is ``node, out_degree, splits, page_rank``.  A round sends each
  node's share ``PR / outdeg`` to its ``splits`` salts (a shuffle of about
  ``n`` rows) and joins it to the cached edges in place (the edges never move
  again).  The shares per ``dst`` and every node's own state row then go
  through one partial + final aggregate on ``node`` (map-side combine, so an
  in-hub is no hot key): that single shuffle yields the whole new state, with
  no join back.
* Nodes without out-links pass nothing on but their sum ``D``.  Where they are
  many, edges to them are marked while laying out (``tail``), and all rounds but
  the last sum those edges into one row (``node`` NULL, its rank is ``D``): such
  a round moves and writes the other nodes only.  The last one ranks every node.
* STRING ids are replaced by 64-bit fingerprints while the rounds run, after a
  check that no two nodes of the graph share one (else they stay as they are);
  the result gets its ids back from the node table.
* The layout is sorted within its partitions, so that no round sorts the edges.
* The node table comes from one pass over the edges (``_ends``) and is
  checkpointed before the hubs are looked up in it.
* Each round's state is written as a Parquet table under the shared folder
  named by ``spark.checkpoint.dir`` and read back, which cuts the lineage (the
  plan does not grow with the rounds) and means a lost executor only costs
  the current round.  One pass per round writes compressed columns; a
  round's table is deleted once the next one is written and measured.  The state
  read back is shuffled on ``node`` for the left join (about ``n`` rows); the
  edges, the big side, stay where the layout put them.
* What the next round and the stopping rule need to know of a round (rank of
  dangling nodes, L1 change, sum of ranks, rows) is observed while its table
  is written: one job a round.
* After each round a manifest beside the tables says which round is whole, so
  a run that has lost its driver goes on from there (``run_dir=``).
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bigraph.functions import hot_keys, with_group_totals
from bigraph.operators.graph import node_degrees, weighted_edges
from bigraph.session import checkpoint_dir, checkpointed, delete_folder, new_folder

log = logging.getLogger(__name__)

DEFAULT_SPLIT_EDGES = 100_000
DEFAULT_EDGES_PER_PARTITION = 4_000_000   # about 100 MB of (src, salt, dst) rows
DEFAULT_DAMPING = 0.85


class PageRankNotConverged(RuntimeError):
    pass


# ---------------------------------------------------------------------------
# One step as plain relational operators (lazy; used for single-step queries)
# ---------------------------------------------------------------------------

def _splits(links, split_edges: int):
    return F.greatest(F.lit(1), F.ceil(links / F.lit(split_edges))).cast("int")


def _ends(weighted: DataFrame, split_edges: int) -> DataFrame:
    """``node, out_degree, links, in_links, splits`` of every node, from one
    pass: ``out_degree`` counts copies, ``links`` distinct targets (what salts
    can spread), ``in_links`` distinct sources."""
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.col("mult").alias("deg"), F.lit(1).alias("out"), F.lit(0).alias("inn")),
        F.struct(F.col("dst").alias("node"), F.lit(0).cast("bigint").alias("deg"), F.lit(0).alias("out"),
                 F.lit(1).alias("inn"))))
    return (weighted.select(ends.alias("e")).groupBy(F.col("e.node").alias("node"))
            .agg(F.sum("e.deg").alias("out_degree"), F.sum("e.out").alias("links"), F.sum("e.inn").alias("in_links"))
            .withColumn("splits", _splits(F.col("links"), split_edges)))


def _fingerprint(c: str):
    return F.xxhash64(F.col(c))


def _unlike(nodes: DataFrame) -> bool:
    """Whether all nodes have fingerprints of their own."""
    prints = nodes.groupBy(_fingerprint("node").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return not prints.where(F.col("n") > 1).limit(1).collect()


def _bounded(deg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The node table with ``splits`` 1 for hubs that the bounded broadcast
    table passes over, and that table (``src, hub_splits``)."""
    hubs = hot_keys(deg.where(F.col("splits") > 1), "links", "node", 0).select(
        F.col("node").alias("src"), F.col("splits").alias("hub_splits"))
    nodes = (deg.drop("splits").join(hubs, F.col("node") == F.col("src"), "left")
             .withColumn("splits", F.coalesce("hub_splits", F.lit(1))).drop("src", "hub_splits"))
    return nodes, hubs


def _salted(weighted: DataFrame, hubs: DataFrame) -> DataFrame:
    """``src, salt, dst, mult``: a hub's distinct targets spread over
    ``splits(src)`` salts by a hash of ``dst``."""
    salt = (F.when(F.col("hub_splits").isNull(), F.lit(0))
            .otherwise(F.pmod(F.xxhash64("dst"), F.col("hub_splits").cast("bigint")).cast("int")))
    rest = [c for c in weighted.columns if c != "src"]
    return weighted.join(hubs, "src", "left").select("src", salt.alias("salt"), *rest)


def _marked(weighted: DataFrame, nodes: DataFrame, split_edges: int) -> DataFrame:
    """``src, dst, mult, tail``: whether the target has no out-links.  Edges
    meet their target, those of an in-hub in several tasks."""
    going_on = nodes.where(F.col("out_degree") > 0).select(F.col("node").alias("dst"), "in_links")
    return (with_group_totals(weighted, going_on, "dst", "src", "in_links", split_edges)
            .select("src", "dst", "mult", F.col("in_links").isNull().alias("tail")))


def _shares(state: DataFrame) -> DataFrame:
    """``src, salt, share``: each node's ``PR / outdeg`` sent to its salts."""
    return (state.where(F.col("out_degree") > 0)
            .select(F.col("node").alias("src"),
                    F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("salt"),
                    (F.col("page_rank") / F.col("out_degree")).alias("share")))


def _flow():
    """Share carried by an edge row: copies of an edge carry it ``mult`` times
    (``x * 1`` is exact, so single edges carry exactly their share)."""
    return F.col("share") * F.col("mult")


def _state(weighted: DataFrame, ranks: DataFrame) -> DataFrame:
    """``node, page_rank, out_degree, links`` of the nodes that ``ranks``
    holds: rank rows and degree rows meet in one aggregate on the node.  The
    conditions keep all columns in every use, so that these share it."""
    none = F.lit(0).cast("bigint")
    have = ranks.select("node", "page_rank", none.alias("out_degree"), none.alias("links"))
    degrees = node_degrees(weighted).select("node", F.lit(None).cast("double").alias("page_rank"), "out_degree", "links")
    return (have.unionByName(degrees).groupBy("node")
            .agg(F.max("page_rank").alias("page_rank"), F.sum("out_degree").alias("out_degree"),
                 F.sum("links").alias("links"))
            .where(F.col("page_rank").isNotNull() & (F.col("out_degree") >= F.col("links"))))


def _flows(weighted: DataFrame, state: DataFrame, split_edges: int) -> DataFrame:
    """``node, share``: what each edge row brings to its target.  Edges meet
    the share of their source, a hub's edges in several tasks."""
    shares = state.where(F.col("out_degree") > 0).select(
        F.col("node").alias("src"), (F.col("page_rank") / F.col("out_degree")).alias("share"), "links")
    return (with_group_totals(weighted, shares, "src", "dst", "links", split_edges)
            .where(F.col("share").isNotNull()).select(F.col("dst").alias("node"), _flow().alias("share")))


def rank_contributions(edges: DataFrame, ranks: DataFrame,
                       split_edges: int = DEFAULT_SPLIT_EDGES) -> DataFrame:
    """``node, incoming``: sum of ``PR(u) / outdeg(u)`` over in-edges.

    Nodes without in-links have no row.  Copies of an edge are combined first;
    the edges meet the shares on ``src``, those of hubs (more than
    ``split_edges`` targets) spread over several tasks, and the sum per target
    is combined map-side.
    """
    weighted = weighted_edges(edges)
    flows = _flows(weighted, _state(weighted, ranks), split_edges)
    return flows.groupBy("node").agg(F.sum("share").alias("incoming"))


def dangling_mass(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row ``dangling_mass``: total rank of nodes without out-links; 0.0
    when there are none (A9)."""
    has_out = edges.select(F.col("src").alias("node")).distinct()
    return (ranks.join(has_out, "node", "left_anti")
            .agg(F.coalesce(F.sum("page_rank"), F.lit(0.0)).alias("dangling_mass")))


def _updated_rank(incoming, dangling, node, n, damping: float | None,
                  node_range: tuple[int, int] | None):
    """New rank expression from the incoming sum, the dangling mass and the
    number of nodes (columns)."""
    s = F.coalesce(incoming, F.lit(0.0))
    if damping is None:
        return s
    share = dangling / n
    if node_range is not None:
        lo, hi = node_range
        share = F.when((node >= F.lit(lo)) & (node < F.lit(hi)), share).otherwise(F.lit(0.0))
    return F.lit(1.0 - damping) / n + F.lit(damping) * (share + s)


def rank_step(edges: DataFrame, ranks: DataFrame, damping: float | None = DEFAULT_DAMPING,
              n_nodes: int | None = None, node_range: tuple[int, int] | None = None,
              split_edges: int = DEFAULT_SPLIT_EDGES) -> DataFrame:
    """``node, page_rank`` after one step (J1, J4, P9), all in one plan.

    ``damping=None`` is the simplified step.  ``ranks`` must hold every node;
    their number is counted unless given.  The edges are read once.
    """
    weighted = weighted_edges(edges)
    state = _state(weighted, ranks)
    # Every node's own row (without a share) makes it appear in the sums.
    carried = state.select("node", F.lit(None).cast("double").alias("share"))
    sums = (_flows(weighted, state, split_edges).unionByName(carried)
            .groupBy("node").agg(F.sum("share").alias("incoming")))
    whole = state.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("counted"),
                      F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("page_rank"))), F.lit(0.0)).alias("dangling_mass"))
    n = F.col("counted") if n_nodes is None else F.lit(max(n_nodes, 1))
    out = sums.crossJoin(F.broadcast(whole))        # one row
    return out.select("node", _updated_rank(F.col("incoming"), F.col("dangling_mass"), F.col("node"), n,
                                            damping, node_range).alias("page_rank"))


def rank_mass(ranks: DataFrame) -> DataFrame:
    """One row ``rank_mass``: the sum of all ranks."""
    return ranks.agg(F.coalesce(F.sum("page_rank"), F.lit(0.0)).alias("rank_mass"))


# ---------------------------------------------------------------------------
# The iteration
# ---------------------------------------------------------------------------

@dataclass
class RankGraph:
    """An edge list laid out for repeated rank steps (see module notes)."""

    layout: DataFrame      # src, salt, dst, mult (, tail)   partitioned and sorted by (src, salt), cached
    nodes: DataFrame       # node, out_degree, links, in_links, splits   cached
    n_nodes: int
    n_links: int
    n_dangling: int
    partitions: int
    run_dir: str
    names: DataFrame | None = None     # node (fingerprint), name: of a graph whose ids are texts
    setting: dict = field(default_factory=dict)     # what a manifest must agree on
    rounds: list[dict] = field(default_factory=list)  # metrics of the rounds of this run

    def release(self) -> None:
        self.layout.unpersist()
        self.nodes.unpersist()


def _default_parallelism(spark) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no local JVM context (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare_graph(edges: DataFrame, dedupe_edges: bool = False,
                  split_edges: int = DEFAULT_SPLIT_EDGES, partitions: int | None = None,
                  edges_per_partition: int = DEFAULT_EDGES_PER_PARTITION, run_dir: str | None = None,
                  mark_tails: bool = False, fingerprints: bool = True) -> RankGraph:
    """Lay out ``edges`` for the iteration and count the nodes.

    The layout gets ``partitions`` partitions; by default as many as hold
    about ``edges_per_partition`` edges each (at least the default
    parallelism), so it follows the data and not the session's shuffle
    setting: every round runs one task per layout partition.  The rounds are
    written to ``run_dir`` (by default a fresh folder under the shared one).
    ``mark_tails`` marks edges to nodes without out-links, if a quarter of all
    nodes or more are such (see module notes); it changes no result.  STRING ids
    stay as they are without ``fingerprints`` (an id range needs them).
    """
    spark = edges.sparkSession
    # Copies of an edge become one row with their number; the result feeds
    # the node table and the layout, so it is kept for the preparation only.
    checkpoint_dir(spark)
    weighted = weighted_edges(edges, dedupe_edges).persist(StorageLevel.MEMORY_AND_DISK)
    deg, names = checkpointed(_ends(weighted, split_edges)), None
    edge_rows = weighted
    if fingerprints and deg.schema["node"].dataType.typeName() == "string" and _unlike(deg):
        names = deg.select(_fingerprint("node").alias("node"), F.col("node").alias("name"))
        deg = deg.withColumn("node", _fingerprint("node"))
        edge_rows = weighted.select(_fingerprint("src").alias("src"), _fingerprint("dst").alias("dst"), "mult")
    nodes, hubs = _bounded(deg)
    nodes = nodes.persist(StorageLevel.MEMORY_AND_DISK)
    # One job fills the node cache and counts nodes and layout rows.
    sizes = nodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("links"), F.lit(0)).alias("m"),
                      F.count(F.when(F.col("out_degree") == 0, 1)).alias("dangling")).first()
    n_nodes, n_rows, n_dangling = int(sizes["n"]), int(sizes["m"]), int(sizes["dangling"])
    if partitions is None:
        partitions = max(_default_parallelism(spark), -(-n_rows // edges_per_partition))
    laid = _marked(edge_rows, nodes, split_edges) if mark_tails and 4 * n_dangling >= n_nodes > 0 else edge_rows
    # The checkpoint comes before the layout: a checkpoint of an adaptive plan
    # forgets partitioning and order, and each round would shuffle the edges.
    layout = (checkpointed(_salted(laid, hubs)).repartition(partitions, "src", "salt")
              .sortWithinPartitions("src", "salt").persist(StorageLevel.MEMORY_AND_DISK))
    layout.count()
    weighted.unpersist()
    return RankGraph(layout=layout, nodes=nodes, n_nodes=n_nodes, n_links=n_rows, n_dangling=n_dangling,
                     partitions=partitions, run_dir=run_dir or new_folder(spark, "pagerank"),
                     names=names, setting={"split_edges": split_edges, "dedupe_edges": dedupe_edges}
                     | ({"ids": "xxhash64"} if names is not None else {}))


def _initial_state(graph: RankGraph, n_nodes: int) -> DataFrame:
    # ``coalesce`` (no shuffle) keeps the first round as coarse as the layout
    # when the session's shuffle setting is finer than the data needs.
    return (graph.nodes.coalesce(graph.partitions)
            .select("node", "out_degree", "splits", F.lit(1.0 / max(n_nodes, 1)).alias("page_rank")))


def _round(graph: RankGraph, state: DataFrame, n_nodes: int, damping: float | None,
           node_range: tuple[int, int] | None, dangling_mass: float, keep_previous: bool = False,
           dangling: tuple[int, int] | None = None) -> DataFrame:
    """One round.  With ``keep_previous`` the new state also holds the old
    rank as ``previous``, so the change of the round is known from its rows.
    With ``dangling`` (how many nodes without out-links there are, and how
    many of them lie in ``node_range``) these share one row, ``node`` NULL."""
    shares = _shares(state)
    null_double = F.lit(None).cast("double")
    target = F.col("dst") if dangling is None else F.when(~F.col("tail"), F.col("dst"))
    # A merge join: edges are read in place and in order.  Spark would plan a
    # broadcast from the size of the state's files, which says nothing of the
    # salts it is exploded to.
    flows = (graph.layout.join(shares.hint("merge"), ["src", "salt"])
             .select(target.alias("node"), _flow().alias("share"),
                     F.lit(None).cast("bigint").alias("out_degree"), F.lit(None).cast("int").alias("splits")))
    # Every node's own row rides along in the same aggregation (with a NULL
    # share), so one shuffle on ``node`` yields the whole new state: no join.
    # Marked targets have in-links and need none.
    own = state.where(F.col("out_degree") > 0) if "tail" in graph.layout.columns and not keep_previous else state
    carried = own.select("node", null_double.alias("share"), "out_degree", "splits",
                         *([F.col("page_rank").alias("previous")] if keep_previous else []))
    aggs = [F.sum("share").alias("incoming"), F.coalesce(F.max("out_degree"), F.lit(0)).cast("bigint").alias("out_degree"),
            F.coalesce(F.max("splits"), F.lit(1)).alias("splits")]
    if keep_previous:
        aggs.append(F.max("previous").alias("previous"))
        flows = flows.withColumn("previous", null_double)
    summed = flows.unionByName(carried).groupBy("node").agg(*aggs)
    rank = _updated_rank(F.col("incoming"), F.lit(dangling_mass), F.col("node"), F.lit(n_nodes), damping, node_range)
    if dangling is not None and damping is not None:
        count, reached = dangling
        together = (F.lit(count * (1.0 - damping) / n_nodes)
                    + F.lit(damping) * (F.lit(reached * dangling_mass / n_nodes) + F.coalesce("incoming", F.lit(0.0))))
        rank = F.when(F.col("node").isNull(), together).otherwise(rank)
    cols = ["node", "out_degree", "splits", rank.alias("page_rank")]
    if keep_previous:
        cols.append("previous")
    return summed.select(*cols)


def _cut(graph: RankGraph, state: DataFrame, number: int) -> tuple[DataFrame, dict]:
    """Write round ``number`` as a table in the run's folder and read it back:
    one job, in which the round's metrics are observed, and the lineage ends
    here.  The observed columns are summed by the tasks that write, so what is
    run again after a loss is not counted twice."""
    spark = state.sparkSession
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), F.sum("page_rank").alias("rank_mass"),
               F.sum(F.when(F.col("out_degree") == 0, F.col("page_rank"))).alias("dangling_mass")]
    if "previous" in state.columns:
        metrics.append(F.sum(F.abs(F.col("page_rank") - F.col("previous"))).alias("l1_change"))
    path = f"{graph.run_dir}/round-{number:05d}"
    state.observe(seen, *metrics).write.mode("overwrite").parquet(path)
    got = {k: float(v or 0.0) for k, v in seen.get.items()}
    return spark.read.schema(state.schema).parquet(path), got


def _file(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _save_manifest(spark, run_dir: str, manifest: dict) -> None:
    """Written under another name first, then renamed: always whole."""
    for name in ("manifest.new", "manifest.json"):
        path, fs = _file(spark, f"{run_dir}/{name}")
        if name == "manifest.new":
            out = fs.create(path, True)
            out.write(bytearray(json.dumps(manifest).encode()))
            out.close()
            new = path
        else:
            fs.delete(path, False)
            if not fs.rename(new, path):
                raise OSError(f"could not write {run_dir}/{name}")


def _load_manifest(spark, run_dir: str) -> dict | None:
    """The manifest; a loss between deleting and renaming leaves the new one."""
    for name in ("manifest.json", "manifest.new"):
        path, fs = _file(spark, f"{run_dir}/{name}")
        if fs.exists(path):
            source = fs.open(path)
            try:
                return json.loads(bytes(source.readAllBytes()).decode())
            finally:
                source.close()
    return None


def iterate_ranks(graph: RankGraph, n_iterations: int, damping: float | None,
                  n_nodes: int | None = None, node_range: tuple[int, int] | None = None,
                  tol: float | None = None) -> tuple[DataFrame, int]:
    """Run up to ``n_iterations`` rounds; with ``tol`` stop once the L1 change
    is below ``n * tol``.  Returns the state and the rounds run.

    Rounds that the manifest of the graph's ``run_dir`` records as whole are
    not run again; it must stem from the same graph and settings.
    """
    if graph.names is not None and node_range is not None:
        raise ValueError("a graph whose ids are fingerprints has no id range")
    state, done = _iterate(graph, n_iterations, damping, n_nodes, node_range, tol)
    if graph.names is not None:
        state = (state.join(graph.names, "node").drop("node")
                 .select(F.col("name").alias("node"), *[c for c in state.columns if c != "node"]))
    return state, done


def _iterate(graph: RankGraph, n_iterations: int, damping: float | None, n_nodes: int | None,
             node_range: tuple[int, int] | None, tol: float | None) -> tuple[DataFrame, int]:
    n = graph.n_nodes if n_nodes is None else n_nodes
    state = _initial_state(graph, n)
    if n == 0:  # empty graph: nothing to rank
        return state, 0
    spark = state.sparkSession
    setting = {**graph.setting, "damping": damping, "n_nodes": n, "nodes": graph.n_nodes, "links": graph.n_links,
               "dangling": graph.n_dangling, "node_range": list(node_range) if node_range else None,
               "keeps_previous": tol is not None}
    metrics = {"dangling_mass": graph.n_dangling * (1.0 / n)}
    dangling = None
    if "tail" in graph.layout.columns and tol is None:
        reached = graph.n_dangling
        if node_range is not None and damping is not None and n_iterations > 1:
            lo, hi = (F.lit(x) for x in node_range)
            reached = graph.nodes.where((F.col("out_degree") == 0) & (F.col("node") >= lo) & (F.col("node") < hi)).count()
        dangling = (graph.n_dangling, reached)
    done, found = 0, _load_manifest(spark, graph.run_dir)
    if found is not None:
        if found["setting"] != setting:
            raise ValueError(f"{graph.run_dir} holds a run of another graph or other settings: {found['setting']}")
        graph.rounds = found["rounds"]
        done = len(graph.rounds)
        if done > n_iterations:
            raise ValueError(f"{graph.run_dir} is already at round {done}")
        if done == n_iterations and graph.rounds and graph.rounds[-1].get("together"):
            graph.rounds.pop()          # that round did not rank every node: again, from the one before
            done -= 1
        if done:
            metrics = graph.rounds[-1]
            schema = "node " + state.schema["node"].dataType.simpleString() + (
                ", out_degree bigint, splits int, page_rank double" + (", previous double" if tol is not None else ""))
            state = spark.read.schema(schema).parquet(f"{graph.run_dir}/round-{done - 1:05d}")
            if tol is not None and metrics["l1_change"] < n * tol:
                return state, done
    for i in range(done, n_iterations):
        together = dangling if i + 1 < n_iterations else None
        new = _round(graph, state, n, damping, node_range, metrics["dangling_mass"], keep_previous=tol is not None,
                     dangling=together)
        state, metrics = _cut(graph, new, i)
        metrics["together"] = together is not None
        graph.rounds.append(metrics)
        _save_manifest(spark, graph.run_dir, {"setting": setting, "rounds": graph.rounds})
        if i > 1:
            delete_folder(spark, f"{graph.run_dir}/round-{i - 2:05d}")
        if tol is not None and metrics["l1_change"] < n * tol:
            return state, i + 1
    if tol is not None:
        raise PageRankNotConverged(f"no convergence within {n_iterations} rounds")
    return state, n_iterations


def _ranks(state: DataFrame) -> DataFrame:
    return state.select("node", "page_rank")


def pagerank_simple(edges: DataFrame, n_iterations: int = 10, n_nodes: int | None = None,
                    **layout) -> DataFrame:
    """``node, page_rank`` after ``n_iterations`` simplified rounds (G1).

    ``run_dir`` names a folder on shared storage for the rounds; a run that was
    cut short goes on from its last whole round when called again with the same
    folder, edges and settings (also for more rounds).  Other ``layout``
    settings are those of :func:`prepare_graph`.
    """
    graph = prepare_graph(edges, mark_tails=n_iterations > 1, **layout)
    try:
        state, _ = iterate_ranks(graph, n_iterations, None, n_nodes)
    finally:
        graph.release()
    return _ranks(state)


def pagerank_complete(edges: DataFrame, n_iterations: int = 10, damping: float = DEFAULT_DAMPING,
                      n_nodes: int | None = None, node_range: tuple[int, int] | None = None,
                      **layout) -> DataFrame:
    """``node, page_rank`` after ``n_iterations`` complete rounds (G2, G3);
    ``run_dir`` as in :func:`pagerank_simple`."""
    graph = prepare_graph(edges, mark_tails=n_iterations > 1, **{"fingerprints": node_range is None, **layout})
    try:
        state, _ = iterate_ranks(graph, n_iterations, damping, n_nodes, node_range)
    finally:
        graph.release()
    return _ranks(state)


def pagerank_converged(edges: DataFrame, damping: float = DEFAULT_DAMPING, max_iter: int = 50,
                       tol: float = 1e-6, dedupe_edges: bool = True, **layout) -> DataFrame:
    """``node, page_rank`` of complete rounds until the L1 change of a round is
    below ``n * tol`` (G4).  Duplicate edges are dropped by default.  Raises
    :class:`PageRankNotConverged` after ``max_iter`` rounds; with ``run_dir``
    (as in :func:`pagerank_simple`) it can be called again with more."""
    graph = prepare_graph(edges, dedupe_edges=dedupe_edges, **layout)
    try:
        state, _ = iterate_ranks(graph, max_iter, damping, tol=tol)
    finally:
        graph.release()
    return _ranks(state)
