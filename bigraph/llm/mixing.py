"""Mixing sources to target weights.

Word totals per source (combined map-side, so a hot source is one row per
task) give each source a target: sources share all words by weight, none gets
more than ``repeat`` times its own size, and what a capped source leaves is
shared by weight among the others.  The repetition rate of a source is target
over size; a document is emitted floor(rate) times, plus once more when a hash
of its id is under the fraction.  Built-in functions on the rows; the sources,
however many, are ranked by range partitions, and the capped ones are found by
rounds of one aggregate each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bigraph.functions import DEFAULT_MAX_ENTRIES, with_group_totals
from bigraph.llm.common import WORD, fresh, materialize, with_rank

WEIGHTS = (5, 2, 1)         # of the sources by code point, repeating
REPEAT = 3                  # a source's target is at most so many times its size
SEED = "mix"


def sized(text: Column):
    """The number of words of a text (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(docs: DataFrame, source: str = "source", text: str = "text", weights=WEIGHTS,
                   repeat: int = REPEAT) -> DataFrame:
    """``source, n, source_size, target, rate``: one row per source (NULL is
    one) with its number of documents.

    The uncapped sources share by weight what the capped ones leave; a source
    is capped if ``repeat`` times its size is at most its share.  Capping
    raises the shares of the others, so the set of capped sources only grows:
    it is found by rounds, each a one-row aggregate over the sources.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(sized(F.col(text))).alias("source_size"))
    ranked = with_rank(sizes, [F.col("source").asc_nulls_last()], "rank").withColumn(
        "w", F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = materialize(ranked, "sources")
    wide = lambda c: c.cast("decimal(38,0)")
    total = ranked.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    rest, free, found = total["size"] or 0, total["w"] or 0, -1
    while True:
        capped = (wide(repeat * F.col("source_size")) * F.lit(free).cast("decimal(18,0)")
                  <= wide(F.col("w")) * F.lit(rest).cast("decimal(18,0)"))
        got = ranked.where(capped).agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("size"),
                                       F.sum("w").alias("w")).first()
        if got["n"] == found or not free:
            break
        found = got["n"]
        rest, free = total["size"] - repeat * (got["size"] or 0), total["w"] - (got["w"] or 0)
    # The last round's share decides for all.
    if not free:
        capped = F.lit(True)
    target = (F.when(capped, (repeat * F.col("source_size")).cast("double"))
              .otherwise((F.col("w") * F.lit(rest)).cast("double") / F.lit(float(max(free, 1)))))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(repeat))))
    return (ranked.withColumn("target", target)
            .select("source", "n", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate")))


def names(columns: list[str]) -> dict[str, str]:
    """The names of the columns that :func:`mixed` adds to a table with
    ``columns``: as they are, or changed where the table has them."""
    return {k: fresh(f"__mix_{k}", columns) for k in ("size", "source_size", "target", "copies")}


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS,
          repeat: int = REPEAT, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` with ``__mix_size, __mix_source_size,
    __mix_target, __mix_copies`` (see :func:`names` for tables that have such
    columns themselves).

    ``__mix_copies`` is floor(rate) plus a Bernoulli copy whose draw is the first
    52 bits of MD5(seed, id) as a fraction, so reruns agree.

    Edge cases: a NULL text has size 0; NULL is a source of its own, after all
    others; sources without words get target 0 and no copies.  Rows with the
    same id (also NULL ones) share a draw and are each emitted.  An empty table
    gives no rows; other columns are kept, whatever their names.
    """
    columns, add = docs.columns, names(docs.columns)
    targets = materialize(source_targets(docs, source, text, weights, repeat), "targets")
    of = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    # The caller's columns travel by number, so no name can clash.
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at = {c: F.col(f"c{columns.index(c)}") for c in (key, source, text)}
    rows = plain.select("*", of(at[source].cast("string")).alias("of"), sized(at[text]).alias("size"),
                        F.concat(F.lit(seed + ":"), F.coalesce(at[key].cast("string"), F.lit("null"))).alias("name"))
    t = targets.select(of(F.col("source").cast("string")).alias("of"), "n", "source_size", "target", "rate")
    # A hot source's rows are spread over the tasks of the join.
    out = with_group_totals(rows, t, "of", "name", "n", DEFAULT_MAX_ENTRIES)
    draw = F.conv(F.substring(F.md5("name"), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
    whole = F.floor(F.col("rate"))
    copies = (whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.col("size").alias(add["size"]),
                      F.col("source_size").alias(add["source_size"]), F.col("target").alias(add["target"]),
                      copies.alias(add["copies"]))


def emit(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each row repeated (or left out) by its number of copies."""
    columns, copies = docs.columns, names(docs.columns)["copies"]
    out = mixed(docs, **settings)
    one = fresh("_copy", out.columns)
    return (out.where(F.col(copies) > 0)
            .withColumn(one, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*columns))


def mix_sql(weights=WEIGHTS, repeat: int = REPEAT, seed: str = SEED) -> str:
    """DuckDB SQL of the mixing query over ``documents``."""
    common = 1
    for w in weights:
        common *= w
    pick = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CAST(CASE rank % {len(weights)} {pick} END AS HUGEINT) AS w FROM r),
f AS (
  SELECT *, sum(source_size) OVER () AS total,
    sum(source_size) OVER () - {repeat} * coalesce(sum(source_size) OVER (
      ORDER BY source_size * ({common} // w), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_here,
    sum(w) OVER (ORDER BY source_size * ({common} // w), rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM w
),
c AS (SELECT *, {repeat} * source_size * weight_left <= w * rest_here AS capped FROM f),
t AS (
  SELECT source, source_size,
    CASE WHEN capped THEN CAST({repeat} * source_size AS DOUBLE)
         ELSE CAST(w * (total - coalesce(sum(CASE WHEN capped THEN {repeat} * source_size END) OVER (), 0)) AS DOUBLE)
              / CAST(sum(CASE WHEN NOT capped THEN w END) OVER () AS DOUBLE) END AS target
  FROM c
),
q AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN least(target / source_size, {float(repeat)!r}) ELSE 0.0 END AS rate FROM t
),
m AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, CAST(q.rate AS DOUBLE) AS rate,
    CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) * size AS taken
FROM m"""
