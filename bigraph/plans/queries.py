"""Registered queries: one per operator of the survey, each as a Spark plan
over the driver's tables ``(spark, sf_dir) -> DataFrame`` and, where SQL can
say it, the equivalent DuckDB SQL.

Every query reads whole tables.  The two engines sum in different orders, so
ranks are shown here (not in the operators) to 12 decimals, and top-N queries
order by nine significant digits of the unrounded rank, which tells ranks apart
at any number of nodes.  Bigram probabilities are exact count ratios in both
and are not rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bigraph.functions import sorted_entries_text, sorted_list_text
from bigraph.operators import bigrams as B
from bigraph.operators import graph as G
from bigraph.operators import pagerank as P
from bigraph.operators.ranking import significant, top_n
from bigraph.plans import oracle as O
from bigraph.sources import files as S
from bigraph.sources import sinks as K
from bigraph.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries (the SQL below uses the same).
ROUNDS = 10                  # rank rounds of the simplified and complete runs
DAMPING = 0.85
PROBE_WORD = "the"           # next_words
TOP_K = 10                   # top_next_words
TOP_N = 20                   # top_n
MAX_CONVERGED = 50           # rounds that pagerank_converged may take
TOL = 1e-6                   # its L1 change per node
SPLIT = 1_000                # max_entries of the queries that split hot keys
HUB = 4                      # the same for out-links: most parts have more

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def _r(c: str = "page_rank"):
    return F.round(F.col(c), O.ROUND).alias(c)


def _top(ranks: DataFrame, n: int) -> DataFrame:
    return top_n(ranks, n, significant("page_rank")).select("node", _r())


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bigram_counts(B.bigrams(T.documents(spark, sf_dir, T.TASK_BYTES)))


def _probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bigram_probabilities(_counts(spark, sf_dir))


# --------------------------------------------------------------------- text

@register("normalize_text", f"SELECT doc_id, {O.NORMALIZED} AS normalized FROM documents")
def q_normalize_text(spark, sf_dir):
    return B.normalized_documents(T.documents(spark, sf_dir))


@register("tokenize", "WITH " + O.TOKENS_CTE + """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, w[i] AS token
FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM toks)""")
def q_tokenize(spark, sf_dir):
    return B.document_tokens(T.documents(spark, sf_dir))


@register("bigrams", "WITH " + O.PAIRS_CTE + "\nSELECT doc_id, word, next_word FROM pairs")
def q_bigrams(spark, sf_dir):
    return B.bigrams(T.documents(spark, sf_dir), keep=("doc_id",))


@register("bigram_counts", "WITH " + O.COUNTS_CTE + "\nSELECT word, next_word, n FROM counts")
def q_bigram_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@register("word_totals", "WITH " + O.COUNTS_CTE + "\nSELECT word, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY word")
def q_word_totals(spark, sf_dir):
    return B.word_totals(_counts(spark, sf_dir))


@register("stripes", O.stripes_sql())
def q_stripes(spark, sf_dir):
    s = B.stripes(_counts(spark, sf_dir))
    return s.select("word", "part", "parts", "total", F.size("stripe").cast("bigint").alias("n_entries"),
                    sorted_entries_text(F.col("stripe")).alias("stripe"))


@register("stripes_split", O.stripes_sql(SPLIT))
def q_stripes_split(spark, sf_dir):
    """Stripes with a small limit, so that frequent words have several parts."""
    s = B.stripes(_counts(spark, sf_dir), SPLIT)
    return s.select("word", "part", "parts", "total", F.size("stripe").cast("bigint").alias("n_entries"),
                    sorted_entries_text(F.col("stripe")).alias("stripe"))


@register("bigram_probabilities_split", "WITH " + O.PROBS_CTE + "\nSELECT word, next_word, probability FROM probs")
def q_bigram_probabilities_split(spark, sf_dir):
    """Probabilities with a small limit, so that frequent words take the path
    of hot words."""
    return B.bigram_probabilities(_counts(spark, sf_dir), SPLIT)


@register("bigram_probabilities", "WITH " + O.PROBS_CTE + "\nSELECT word, next_word, probability FROM probs")
def q_bigram_probabilities(spark, sf_dir):
    return _probs(spark, sf_dir)


@register("bigram_probabilities_from_stripes",
          "WITH " + O.PROBS_CTE + "\nSELECT word, next_word, probability FROM probs")
def q_bigram_probabilities_from_stripes(spark, sf_dir):
    return B.bigram_probabilities_from_stripes(B.stripes(_counts(spark, sf_dir)))


@register("keyed_probabilities",
          "WITH " + O.PROBS_CTE + "\nSELECT word || '-' || next_word AS bigram, probability FROM probs")
def q_keyed_probabilities(spark, sf_dir):
    return B.keyed_probabilities(_probs(spark, sf_dir))


@register("sort_probabilities", "WITH " + O.PROBS_CTE + """
SELECT word, next_word, probability FROM probs ORDER BY word, probability, next_word""")
def q_sort_probabilities(spark, sf_dir):
    return B.sort_probabilities(_probs(spark, sf_dir))


@register("next_words", "WITH " + O.PROBS_CTE + f"""
SELECT word, next_word, probability FROM probs WHERE word = '{PROBE_WORD}'
ORDER BY probability DESC, next_word""")
def q_next_words(spark, sf_dir):
    return B.next_words(_probs(spark, sf_dir), PROBE_WORD)


@register("top_next_words", "WITH " + O.PROBS_CTE + f"""
SELECT * FROM (
  SELECT word, next_word, probability,
         CAST(row_number() OVER (PARTITION BY word ORDER BY probability DESC, next_word) AS INTEGER) AS rank
  FROM probs) WHERE rank <= {TOP_K}""")
def q_top_next_words(spark, sf_dir):
    return B.top_next_words_from_counts(_counts(spark, sf_dir), TOP_K)


# -------------------------------------------------------------------- graph

def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.edges(spark, sf_dir)


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges with their copies counted, for plans that use them twice."""
    return G.weighted_edges(_edges(spark, sf_dir))


@register("node_set", "WITH " + O.EDGES_CTE + "\nSELECT node FROM nodes")
def q_node_set(spark, sf_dir):
    return G.node_set(_edges(spark, sf_dir))


@register("graph_stats", "WITH " + O.EDGES_CTE + "\nSELECT min_node, max_node, n_nodes FROM stats")
def q_graph_stats(spark, sf_dir):
    return G.graph_stats(_edges(spark, sf_dir))


@register("out_degrees", "WITH " + O.EDGES_CTE + "\nSELECT node, out_degree FROM deg")
def q_out_degrees(spark, sf_dir):
    return G.out_degrees(_edges(spark, sf_dir))


@register("dangling_nodes", "WITH " + O.EDGES_CTE + "\nSELECT node FROM deg WHERE out_degree = 0")
def q_dangling_nodes(spark, sf_dir):
    return G.dangling_nodes(_edges(spark, sf_dir))


@register("adjacency", O.adjacency_sql())
def q_adjacency(spark, sf_dir):
    adj = G.adjacency(_edges(spark, sf_dir))
    return adj.select("node", "part", "parts", sorted_list_text(F.col("out_links")).alias("out_links"),
                      "page_rank")


@register("adjacency_split", O.adjacency_sql(HUB))
def q_adjacency_split(spark, sf_dir):
    """Adjacency with a small limit, so that most nodes are cut into parts."""
    adj = G.adjacency(_edges(spark, sf_dir), max_entries=HUB)
    return adj.select("node", "part", "parts", sorted_list_text(F.col("out_links")).alias("out_links"),
                      "page_rank")


@register("initial_ranks", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(0, None)
          + "\nSELECT node, page_rank FROM r0")
def q_initial_ranks(spark, sf_dir):
    return G.initial_ranks(_edges(spark, sf_dir))


@register("rank_contributions", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(0, None) + f"""
SELECT e.dst AS node, round(sum(r.page_rank / d.out_degree), {O.ROUND}) AS incoming
FROM edges e JOIN r0 r ON e.src = r.node JOIN deg d ON d.node = e.src GROUP BY e.dst""")
def q_rank_contributions(spark, sf_dir):
    e = _weighted(spark, sf_dir)
    c = P.rank_contributions(e, G.initial_ranks(e))
    return c.select("node", _r("incoming"))


@register("dangling_mass", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(0, None) + f"""
SELECT round(coalesce(sum(r.page_rank), 0.0), {O.ROUND}) AS dangling_mass
FROM r0 r JOIN deg d ON d.node = r.node WHERE d.out_degree = 0""")
def q_dangling_mass(spark, sf_dir):
    e = _weighted(spark, sf_dir)
    return P.dangling_mass(e, G.initial_ranks(e)).select(_r("dangling_mass"))


def _ranks_sql(rounds: int, damping: float | None, node_range: bool = False) -> str:
    return ("WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(rounds, damping, node_range)
            + f"\nSELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM r{rounds}")


@register("rank_contributions_split", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(0, None) + f"""
SELECT e.dst AS node, round(sum(r.page_rank / d.out_degree), {O.ROUND}) AS incoming
FROM edges e JOIN r0 r ON e.src = r.node JOIN deg d ON d.node = e.src GROUP BY e.dst""")
def q_rank_contributions_split(spark, sf_dir):
    """Contributions with most nodes' edges spread over several salts."""
    e = _weighted(spark, sf_dir)
    return P.rank_contributions(e, G.initial_ranks(e), split_edges=HUB).select("node", _r("incoming"))


@register("pagerank_complete_split", _ranks_sql(ROUNDS, DAMPING))
def q_pagerank_complete_split(spark, sf_dir):
    """Complete PageRank with most nodes' edges spread over several salts."""
    return P.pagerank_complete(_edges(spark, sf_dir), ROUNDS, DAMPING, split_edges=HUB).select("node", _r())


@register("rank_step", _ranks_sql(1, DAMPING))
def q_rank_step(spark, sf_dir):
    e = _weighted(spark, sf_dir)
    return P.rank_step(e, G.initial_ranks(e), damping=DAMPING).select("node", _r())


@register("pagerank_simple", _ranks_sql(ROUNDS, None))
def q_pagerank_simple(spark, sf_dir):
    return P.pagerank_simple(_edges(spark, sf_dir), ROUNDS).select("node", _r())


@register("pagerank_complete", _ranks_sql(ROUNDS, DAMPING))
def q_pagerank_complete(spark, sf_dir):
    return P.pagerank_complete(_edges(spark, sf_dir), ROUNDS, DAMPING).select("node", _r())


@register("pagerank_complete_range", _ranks_sql(ROUNDS, DAMPING, node_range=True))
def q_pagerank_complete_range(spark, sf_dir):
    """The dangling share goes to ids in ``[min_node, max_node)`` only."""
    e = _edges(spark, sf_dir)
    stats = G.graph_stats(e).first()
    ranks = P.pagerank_complete(e, ROUNDS, DAMPING, node_range=(stats["min_node"], stats["max_node"]))
    return ranks.select("node", _r())


def _converged_sql() -> str:
    """All rounds up to the most allowed, the L1 change of each, and the rows
    of the first that changes less than the tolerance."""
    rounds = range(1, MAX_CONVERGED + 1)
    errors = " UNION ALL ".join(
        f"SELECT {k} AS k, sum(abs(a.page_rank - b.page_rank)) AS err FROM r{k} a JOIN r{k - 1} b ON a.node = b.node"
        for k in rounds)
    rows = " UNION ALL ".join(
        f"SELECT node, page_rank FROM r{k} WHERE (SELECT k FROM stop) = {k}" for k in rounds)
    return ("WITH " + O.EDGES_CTE.replace("edges AS (\n  SELECT l_partkey", "edges AS (\n  SELECT DISTINCT l_partkey")
            + ",\n" + O.pagerank_ctes(MAX_CONVERGED, DAMPING)
            + f",\nstop AS MATERIALIZED (SELECT min(k) AS k FROM ({errors}) WHERE err < {TOL!r} * {O._n_expr()}),"
            + f"\nranked AS ({rows})\n")


TOP_CONVERGED = 100  # top_n_converged


@register("pagerank_converged", _converged_sql() + f"SELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM ranked")
def q_pagerank_converged(spark, sf_dir):
    return P.pagerank_converged(_edges(spark, sf_dir), DAMPING).select("node", _r())


@register("top_n", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(ROUNDS, DAMPING) + f"""
SELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM r{ROUNDS}
ORDER BY {O.significant('page_rank')} DESC, node LIMIT {TOP_N}""")
def q_top_n(spark, sf_dir):
    return _top(P.pagerank_complete(_edges(spark, sf_dir), ROUNDS, DAMPING), TOP_N)


@register("rank_mass", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(ROUNDS, None) + f"""
SELECT round(sum(page_rank), {O.ROUND}) AS rank_mass FROM r{ROUNDS}""")
def q_rank_mass(spark, sf_dir):
    return P.rank_mass(P.pagerank_simple(_edges(spark, sf_dir), ROUNDS)).select(_r("rank_mass"))


@register("pagerank_word_graph", "WITH " + O.WORD_GRAPH_CTE + ",\n" + O.pagerank_ctes(ROUNDS, DAMPING)
          + f"\nSELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM r{ROUNDS}")
def q_pagerank_word_graph(spark, sf_dir):
    """Complete PageRank on the second test graph: one STRING-id edge per
    distinct bigram of the documents."""
    ranks = P.pagerank_complete(T.word_edges(_counts(spark, sf_dir)), ROUNDS, DAMPING)
    return ranks.select("node", _r())


@register("top_n_converged", _converged_sql() + f"""
SELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM ranked
ORDER BY {O.significant('page_rank')} DESC, node LIMIT {TOP_CONVERGED}""")
def q_top_n_converged(spark, sf_dir):
    """The 100 highest converged ranks (T4)."""
    return _top(P.pagerank_converged(_edges(spark, sf_dir), DAMPING), TOP_CONVERGED)


@register("top_n_simple", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(ROUNDS, None) + f"""
SELECT node, round(page_rank, {O.ROUND}) AS page_rank FROM r{ROUNDS}
ORDER BY {O.significant('page_rank')} DESC, node LIMIT {TOP_N}""")
def q_top_n_simple(spark, sf_dir):
    """Top 20 of the simplified form (T2 with G1)."""
    return _top(P.pagerank_simple(_edges(spark, sf_dir), ROUNDS), TOP_N)


# ------------------------------------------------------- sources and sinks

def _lines(df: DataFrame, value) -> DataFrame:
    return df.select(value.alias("value"))


@register("parse_lines", """SELECT unnest(string_split(text, chr(10))) AS text FROM documents""")
def q_parse_lines(spark, sf_dir):
    """Every line of the documents is a document."""
    docs = T.documents(spark, sf_dir)
    return S.parse_lines(_lines(docs.select(F.explode(F.split("text", "\n", -1)).alias("value")), F.col("value")))


@register("parse_documents_csv", "SELECT doc_id, text FROM documents")
def q_parse_documents_csv(spark, sf_dir):
    """Documents as quoted CSV records (with line feeds, commas and
    doubled quotes inside), read back."""
    docs = T.documents(spark, sf_dir)
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    lines = _lines(docs, F.concat_ws(",", F.col("doc_id").cast("string"), quoted))
    return S.parse_documents_csv(lines, "ID STRING, Joke STRING")


@register("parse_edges", "WITH " + O.EDGES_CTE + "\nSELECT src, dst FROM edges")
def q_parse_edges(spark, sf_dir):
    """S3: the edges as tab-separated lines, read back."""
    e = _edges(spark, sf_dir)
    return S.parse_edges(_lines(e, F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string"))))


@register("parse_edges_text", "WITH " + O.COUNTS_CTE + "\nSELECT '#' || word AS src, '\"' || next_word AS dst FROM counts")
def q_parse_edges_text(spark, sf_dir):
    """S3 with STRING ids that start with ``#`` or a quote."""
    c = _counts(spark, sf_dir)
    lines = _lines(c, F.concat(F.lit("#"), F.col("word"), F.lit('\t"'), F.col("next_word")))
    return S.parse_edges(lines, "STRING")


@register("probability_lines", "WITH " + O.PROBS_CTE + """
SELECT '"' || word || '-' || next_word || '"' || chr(9) || CAST(probability AS VARCHAR) AS value FROM probs""")
def q_probability_lines(spark, sf_dir):
    """``json(word-next) TAB json(probability)`` lines."""
    return K.probability_lines(B.keyed_probabilities(_probs(spark, sf_dir)))


@register("adjacency_lines", "WITH " + O.EDGES_CTE + f"""
SELECT '"' || CAST(n.node AS VARCHAR) || '"' || chr(9) || '{{"out_links":['
       || coalesce(string_agg('"' || CAST(e.dst AS VARCHAR) || '"', ',' ORDER BY CAST(e.dst AS VARCHAR)), '')
       || '],"page_rank":' || CAST({O.dbl(1.0)} / (SELECT n_nodes FROM stats) AS VARCHAR) || '}}' AS value
FROM nodes n LEFT JOIN edges e ON e.src = n.node GROUP BY n.node""")
def q_adjacency_lines(spark, sf_dir):
    """Adjacency lines with the initial ranks (links sorted, as SQL has to
    put them in some order)."""
    adj = G.adjacency(_edges(spark, sf_dir))
    return K.adjacency_lines(adj.withColumn("out_links", F.array_sort(F.transform("out_links", lambda x: x.cast("string")))))


@register("parse_adjacency", O.adjacency_text_sql())
def q_parse_adjacency(spark, sf_dir):
    """Adjacency lines written and read back, ranks included."""
    back = S.merge_parts(S.parse_adjacency(K.adjacency_lines(G.adjacency(_edges(spark, sf_dir)))))
    return back.select("node", F.array_join(F.array_sort("out_links"), ",").alias("out_links"), "page_rank")


@register("parse_adjacency_split", O.adjacency_sql(HUB, "text"))
def q_parse_adjacency_split(spark, sf_dir):
    """S5 with hubs in parts: the parts survive the lines."""
    back = S.parse_adjacency(K.adjacency_lines(G.adjacency(_edges(spark, sf_dir), max_entries=HUB)))
    return back.select("node", "part", "parts", sorted_list_text(F.col("out_links")).alias("out_links"), "page_rank")


@register("parse_adjacency_merged", O.adjacency_text_sql())
def q_parse_adjacency_merged(spark, sf_dir):
    """Hubs written in parts and put together again."""
    adj = G.adjacency(_edges(spark, sf_dir), max_entries=HUB)
    back = S.merge_parts(S.parse_adjacency(K.adjacency_lines(adj)))
    return back.select("node", F.array_join(F.array_sort("out_links"), ",").alias("out_links"), "page_rank")


@register("parse_adjacency_edges", "WITH " + O.EDGES_CTE + """
SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges""")
def q_parse_adjacency_edges(spark, sf_dir):
    """S5 back to edges: no link is lost on the way."""
    adj = G.adjacency(_edges(spark, sf_dir), max_entries=HUB)
    return S.adjacency_edges(S.parse_adjacency(K.adjacency_lines(adj)))


@register("parse_ranks", "WITH " + O.EDGES_CTE + ",\n" + O.pagerank_ctes(1, DAMPING) + f"""
SELECT CAST(node AS VARCHAR) AS node, round(page_rank, {O.ROUND}) AS page_rank FROM r1""")
def q_parse_ranks(spark, sf_dir):
    """S6 (and S4): ranks after a step as lines, read back."""
    e = _weighted(spark, sf_dir)
    lines = K.rank_lines(P.rank_step(e, G.initial_ranks(e), damping=DAMPING))
    return S.parse_ranks(lines).select("node", _r())
