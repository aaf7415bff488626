"""bigraph: conditional bigram probabilities and link analysis on Spark.

Every operator is a function from DataFrame to DataFrame; the main ones are
re-exported here.
"""

from bigraph.operators.bigrams import (
    bigram_counts,
    bigram_probabilities,
    bigram_probabilities_from_stripes,
    bigrams,
    keyed_probabilities,
    next_words,
    sort_probabilities,
    stripes,
    top_next_words,
    top_next_words_from_counts,
    word_totals,
)
from bigraph.operators.graph import adjacency, dangling_nodes, graph_stats, initial_ranks, node_set, out_degrees
from bigraph.operators.pagerank import (
    PageRankNotConverged,
    dangling_mass,
    pagerank_complete,
    pagerank_converged,
    pagerank_simple,
    rank_contributions,
    rank_mass,
    rank_step,
)
from bigraph.operators.ranking import top_n

__all__ = [
    "PageRankNotConverged",
    "adjacency",
    "bigram_counts",
    "bigram_probabilities",
    "bigram_probabilities_from_stripes",
    "bigrams",
    "dangling_mass",
    "dangling_nodes",
    "graph_stats",
    "initial_ranks",
    "keyed_probabilities",
    "next_words",
    "node_set",
    "out_degrees",
    "pagerank_complete",
    "pagerank_converged",
    "pagerank_simple",
    "rank_contributions",
    "rank_mass",
    "rank_step",
    "sort_probabilities",
    "stripes",
    "top_n",
    "top_next_words",
    "top_next_words_from_counts",
    "word_totals",
]
