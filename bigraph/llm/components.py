"""Connected components of a link table, by alternating large-star and
small-star steps on DataFrames.

Every step is a map-side combined minimum per node and a join back; the link
table is cut to a table in the shared folder after each round.  Nothing but a
count and a checksum of the links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import discard, materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over ``hi, lo`` rows with ``hi > lo``: large-star hangs
    the larger neighbours of a node on the smallest node around it,
    small-star the smaller ones."""
    if large:
        around = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    else:
        around = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = around.join(least, "u")
    if large:
        return hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    return (hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .union(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct())


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo") % F.lit(1 << 40)).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, most: int | None = None) -> DataFrame:
    """``node, component`` for every node with a link to another one;
    ``component`` is the smallest node reachable.  Self-links, repeated links
    and either direction are allowed; NULL ends are ignored.  ``most``: a
    bound on the rows of ``links``, if known."""
    now = materialize(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links", most=most)
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        # No step has more links than the one before: each link hangs one node.
        new = materialize(_star(_star(now, True), False), "star", most=mark[0])
        discard(now)
        now, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
