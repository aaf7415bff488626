"""ANSI SQL (DuckDB dialect) that computes the same results as the registered
queries, over the same parquet tables (views ``documents``, ``lineitem``...).

Used only to check the Spark plans.  The PageRank rounds are unrolled into a
chain of materialised CTEs.  Float constants are written as text cast to
DOUBLE so both engines start from bit-identical values.
"""

from __future__ import annotations

from bigraph.functions.collect import DEFAULT_MAX_ENTRIES

ROUND = 12


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


NORMALIZED = (
    "trim(regexp_replace(regexp_replace(lower(text), '''', '', 'g'), '[^a-z]+', ' ', 'g'))"
)

TOKENS_CTE = f"""toks AS (
  SELECT doc_id, string_split({NORMALIZED}, ' ') AS w FROM documents WHERE text IS NOT NULL
)"""

PAIRS_CTE = TOKENS_CTE + """,
idx AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM toks),
pairs AS (SELECT doc_id, w[i] AS word, w[i + 1] AS next_word FROM idx)"""

COUNTS_CTE = PAIRS_CTE + """,
counts AS (SELECT word, next_word, count(*) AS n FROM pairs GROUP BY word, next_word)"""

PROBS_CTE = COUNTS_CTE + """,
totals AS (SELECT word, sum(n) AS total FROM counts GROUP BY word),
probs AS (
  SELECT c.word, c.next_word, CAST(c.n AS DOUBLE) / t.total AS probability
  FROM counts c JOIN totals t ON c.word = t.word
)"""


def md5_part(expr: str, parts: str) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) % {parts})"


def stripes_sql(max_entries: int = DEFAULT_MAX_ENTRIES) -> str:
    return "WITH " + COUNTS_CTE + f""",
sizes AS (SELECT word, count(*) AS n_next, sum(n) AS word_total FROM counts GROUP BY word),
tagged AS (
  SELECT c.word, c.next_word, c.n,
         CASE WHEN s.n_next > {max_entries} THEN CAST(ceil(s.n_next / {max_entries}) AS INTEGER) ELSE 1 END AS parts,
         s.word_total
  FROM counts c JOIN sizes s ON c.word = s.word
),
parted AS (
  SELECT *, CASE WHEN parts > 1 THEN {md5_part('next_word', 'parts')} ELSE 0 END AS part FROM tagged
)
SELECT word, CAST(part AS INTEGER) AS part, parts,
       CAST(CASE WHEN parts > 1 THEN max(word_total) ELSE sum(n) END AS BIGINT) AS total,
       count(*) AS n_entries,
       string_agg(next_word || ':' || CAST(n AS VARCHAR), ',' ORDER BY next_word) AS stripe
FROM parted GROUP BY word, part, parts"""


GRAPH_CTE = """nodes AS (SELECT src AS node FROM edges UNION SELECT dst FROM edges),
deg AS (
  SELECT n.node, coalesce(o.c, 0) AS out_degree
  FROM nodes n LEFT JOIN (SELECT src, count(*) AS c FROM edges GROUP BY src) o ON o.src = n.node
),
stats AS (SELECT min(node) AS min_node, max(node) AS max_node, count(*) AS n_nodes FROM nodes)"""

EDGES_CTE = """edges AS (
  SELECT l_partkey AS src,
         coalesce(lead(l_partkey) OVER (PARTITION BY l_orderkey
                                        ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity),
                  -1 - l_orderkey) AS dst
  FROM lineitem
),
""" + GRAPH_CTE

WORD_GRAPH_CTE = COUNTS_CTE + """,
edges AS (SELECT word AS src, next_word AS dst FROM counts),
""" + GRAPH_CTE


def _n_expr() -> str:
    return "(SELECT n_nodes FROM stats)"


def pagerank_ctes(rounds: int, damping: float | None, node_range: bool = False,
                  edges: str = "edges", n_nodes: int | None = None) -> str:
    """CTEs ``r0 .. r{rounds}`` of ``node, page_rank``.

    ``n_nodes`` is given as a number when known (the node count is also what
    the Spark side computes), so constants fold the same way in both engines.
    """
    n = _n_expr() if n_nodes is None else str(n_nodes)
    parts = [f"r0 AS MATERIALIZED (SELECT node, {dbl(1.0)} / {n} AS page_rank FROM nodes)"]
    for k in range(rounds):
        incoming = f"""SELECT e.dst AS node, sum(r.page_rank / d.out_degree) AS incoming
      FROM {edges} e JOIN r{k} r ON e.src = r.node JOIN deg d ON d.node = e.src
      GROUP BY e.dst"""
        s = "coalesce(s.incoming, 0.0)"
        if damping is None:
            rank = s
            mass_join = ""
        else:
            share = f"(m.dm / {n})"
            if node_range:
                share = (f"(CASE WHEN n.node >= (SELECT min_node FROM stats) "
                         f"AND n.node < (SELECT max_node FROM stats) THEN {share} ELSE 0.0 END)")
            rank = f"{dbl((1.0 - damping))} / {n} + {dbl(damping)} * ({share} + {s})"
            mass_join = (f"\n    CROSS JOIN (SELECT coalesce(sum(r.page_rank), 0.0) AS dm FROM r{k} r "
                         f"JOIN deg d ON d.node = r.node WHERE d.out_degree = 0) m")
        parts.append(f"""r{k + 1} AS MATERIALIZED (
    SELECT n.node, {rank} AS page_rank
    FROM nodes n LEFT JOIN ({incoming}) s ON s.node = n.node{mass_join}
)""")
    return ",\n".join(parts)


def significant(c: str, digits: int = 9) -> str:
    """``ranking.significant`` in SQL."""
    e = f"CAST({digits} - (floor(log10(abs({c}))) + 1) AS DOUBLE)"
    return f"(CASE WHEN {c} = 0 THEN 0.0 ELSE round({c} * pow(10.0, {e})) / pow(10.0, {e}) END)"


def adjacency_sql(max_entries: int = DEFAULT_MAX_ENTRIES, ids: str = "") -> str:
    """``ids='text'`` gives ids as text, links in the order of their texts."""
    node, link = ("CAST(node AS VARCHAR) AS node", "CAST(dst AS VARCHAR)") if ids == "text" else ("node", "dst")
    return "WITH " + EDGES_CTE + f""",
lists AS (
  SELECT n.node, e.dst,
         CASE WHEN d.out_degree > {max_entries}
              THEN CAST(ceil(d.out_degree / {max_entries}) AS INTEGER) ELSE 1 END AS parts,
         (row_number() OVER (PARTITION BY n.node, e.dst) - 1) // {max_entries} AS chunk
  FROM nodes n JOIN deg d ON d.node = n.node LEFT JOIN edges e ON e.src = n.node
),
keyed AS (
  SELECT *, CASE WHEN chunk = 0 THEN CAST(dst AS VARCHAR)
                 ELSE CAST(dst AS VARCHAR) || '#' || CAST(chunk AS VARCHAR) END AS entry FROM lists
),
parted AS (
  SELECT node, dst, parts, CASE WHEN parts > 1 THEN {md5_part('entry', 'parts')} ELSE 0 END AS part FROM keyed
  UNION ALL
  SELECT DISTINCT node, NULL, parts, 0 FROM lists WHERE parts > 1
)
SELECT {node}, CAST(part AS INTEGER) AS part, parts,
       coalesce(string_agg(CAST(dst AS VARCHAR), ',' ORDER BY {link}), '') AS out_links,
       CASE WHEN part = 0 THEN {dbl(1.0)} / (SELECT n_nodes FROM stats) END AS page_rank
FROM parted GROUP BY parted.node, part, parts"""


def adjacency_text_sql() -> str:
    return "WITH " + EDGES_CTE + f"""
SELECT CAST(n.node AS VARCHAR) AS node,
       coalesce(string_agg(CAST(e.dst AS VARCHAR), ',' ORDER BY CAST(e.dst AS VARCHAR)), '') AS out_links,
       {dbl(1.0)} / (SELECT n_nodes FROM stats) AS page_rank
FROM nodes n LEFT JOIN edges e ON e.src = n.node GROUP BY n.node"""
