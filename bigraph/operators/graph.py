"""Graph basics over an edge list ``src, dst``: node set, statistics,
degrees, dangling nodes, adjacency lists with initial ranks.

Every operator is a plain aggregate or join.  Distinct and degree counts are
partial + final aggregates, so a hub (one node on a third of all edges) is
combined inside each task before anything is shuffled.

An edge has two ends: rows with a NULL one are ignored.  Every operator also
takes *weighted* edges (``src, dst, mult``, see :func:`weighted_edges`); plans
that use the edges several times read them once this way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.functions import DEFAULT_MAX_ENTRIES, n_parts, part_of, with_group_totals
from bigraph.functions.collect import MAX_HOT_KEYS


def _whole(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def weighted_edges(edges: DataFrame, dedupe_edges: bool = False) -> DataFrame:
    """``src, dst, mult``: copies of an edge combined map-side into one row
    that carries their number (1 for every edge with ``dedupe_edges``), so a
    group of copies is one row, never a hot key.  Weighted edges are returned
    as they are.

    All uses of the result in a plan share its one exchange, which Spark takes
    again only if the plans below are equal.  Hence the two conditions that
    are always true: ends are not NULL (a join would say so below one of its
    sides only) and ``mult`` is positive (keeps the count where a use would
    drop it).
    """
    if "mult" in edges.columns:
        return edges
    copies = F.least(F.count(F.lit(1)), F.lit(1)) if dedupe_edges else F.count(F.lit(1))
    return _whole(edges).groupBy("src", "dst").agg(copies.alias("mult")).where(F.col("mult") > 0)


def node_degrees(edges: DataFrame) -> DataFrame:
    """``node, out_degree, links`` of every node from one pass over the edges:
    each edge becomes a row for its source and one for its target, and a
    map-side combined sum makes node set, degrees and dangling nodes fall out
    of one shuffle.  ``out_degree`` counts copies of an edge, ``links`` edge
    rows (no more than copies: the condition keeps both columns in every use,
    so that all uses share the exchange)."""
    copies = F.col("mult") if "mult" in edges.columns else F.lit(1).cast("bigint")
    edges = _whole(edges)
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), copies.alias("deg"), F.lit(1).alias("row")),
                             F.struct(F.col("dst").alias("node"), F.lit(0).cast("bigint").alias("deg"),
                                      F.lit(0).alias("row"))))
    return (edges.select(ends.alias("e")).groupBy(F.col("e.node").alias("node"))
            .agg(F.sum("e.deg").alias("out_degree"), F.sum("e.row").alias("links"))
            .where(F.col("out_degree") >= F.col("links")))


def node_set(edges: DataFrame) -> DataFrame:
    """``node``: sources and targets, each once."""
    return _whole(edges).select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row ``min_node, max_node, n_nodes`` (A10)."""
    nodes = node_set(edges)
    return nodes.agg(F.min("node").alias("min_node"), F.max("node").alias("max_node"),
                     F.count(F.lit(1)).alias("n_nodes"))


def out_degrees(edges: DataFrame) -> DataFrame:
    """``node, out_degree`` for every node; dangling nodes have 0.
    Duplicate edges count twice, self-loops count."""
    return node_degrees(edges).select("node", "out_degree")


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """``node``: nodes without out-links."""
    return node_degrees(edges).where(F.col("out_degree") == 0).select("node")


def count_nodes(edges: DataFrame) -> int:
    """Number of distinct nodes (a one-row aggregate brought to the driver)."""
    return node_set(edges).count()


def _count_of(nodes: DataFrame, n_nodes: int | None) -> DataFrame:
    """One row ``n``: the number of rows (at least 1), counted unless given."""
    if n_nodes is not None:
        return nodes.sparkSession.range(1).select(F.lit(max(n_nodes, 1)).alias("n"))
    return nodes.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n"))


def adjacency(edges: DataFrame, n_nodes: int | None = None, max_entries: int = DEFAULT_MAX_ENTRIES,
              max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``node, part, parts, out_links ARRAY, page_rank``.

    Every node of the graph appears; nodes seen only as targets have an empty
    list.  Duplicate edges stay in the list.  ``page_rank`` is ``1 / n_nodes``
    (counted when not given) on part 0 of a node and NULL on further
    parts, so the ranks still sum to 1.  A node with more than ``max_entries``
    out-links gets ``parts`` rows whose lists together hold every link, so no
    row or task carries a whole hub; copies of one link are spread over the
    parts in chunks of at most ``max_entries``.  The result does not depend on
    ``max_keys``, which bounds a broadcast.
    """
    # Copies of a link are combined map-side, then cut into chunks of at most
    # ``max_entries`` copies, so neither a hub nor a pile of copies of one link
    # makes an unbounded list.
    weighted = weighted_edges(edges)
    degrees = node_degrees(weighted)
    # Only hubs are looked up: at most edges / max_entries nodes.
    hubs = degrees.where(F.col("out_degree") > max_entries).select(F.col("node").alias("src"), "out_degree")
    parts = n_parts(F.col("out_degree"), max_entries)       # 1 for nodes that are not hubs
    chunks = (with_group_totals(weighted, hubs, "src", "dst", "out_degree", max_entries, max_keys)
              .select("src", "dst", "mult", parts.alias("parts"),
                      F.explode(F.sequence(F.lit(0), n_parts(F.col("mult"), max_entries) - 1)).alias("chunk")))
    copies = F.least(F.lit(max_entries).cast("bigint"), F.col("mult") - F.col("chunk") * F.lit(max_entries))
    key = F.when(F.col("chunk") == 0, F.col("dst").cast("string")).otherwise(
        F.concat(F.col("dst").cast("string"), F.lit("#"), F.col("chunk").cast("string")))
    part = F.when(F.col("parts") > 1, part_of(key, F.col("parts"))).otherwise(F.lit(0))
    links = chunks.select(F.col("src").alias("node"), F.array_repeat("dst", copies.cast("int")).alias("dsts"),
                          part.alias("part"), "parts")
    # A header row without links makes part 0 exist for every node, hubs and
    # mere targets too, so the rank can sit on it.
    headers = degrees.select("node", F.array().cast(links.schema["dsts"].dataType).alias("dsts"),
                             F.lit(0).alias("part"), parts.alias("parts"))
    lists = (links.unionByName(headers)
             .groupBy("node", "part", "parts")
             .agg(F.flatten(F.collect_list("dsts")).alias("out_links")))
    rank = F.when(F.col("part") == 0, F.lit(1.0) / F.col("n"))
    return (lists.crossJoin(F.broadcast(_count_of(degrees, n_nodes)))    # one row: the number of nodes
            .withColumn("page_rank", rank)
            .select("node", "part", "parts", "out_links", "page_rank"))


def initial_ranks(edges: DataFrame, n_nodes: int | None = None) -> DataFrame:
    """``node, page_rank = 1/n`` for every node (P7).  The number of nodes,
    unless given, is counted in the same plan from the same node set."""
    nodes = node_set(edges)
    return (nodes.crossJoin(F.broadcast(_count_of(nodes, n_nodes)))      # one row
            .select("node", (F.lit(1.0) / F.col("n")).alias("page_rank")))
