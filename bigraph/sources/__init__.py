"""Sources (files, the driver's tables, derived graphs) and sinks."""

from bigraph.sources.files import (
    adjacency_edges,
    merge_parts,
    parse_adjacency,
    parse_documents_csv,
    parse_edges,
    parse_lines,
    parse_ranks,
    read_adjacency_kv,
    read_documents_csv,
    read_edges,
    read_lines,
    read_ranks_kv,
)
from bigraph.sources.sinks import (
    adjacency_lines,
    double_text,
    json_value,
    probability_lines,
    rank_lines,
    write_adjacency_kv,
    write_kv,
    write_ranks_kv,
)
from bigraph.sources.tables import documents, edges, lineitem_edges, read_table, word_edges

__all__ = [
    "adjacency_edges",
    "adjacency_lines",
    "documents",
    "double_text",
    "edges",
    "json_value",
    "lineitem_edges",
    "merge_parts",
    "parse_adjacency",
    "parse_documents_csv",
    "parse_edges",
    "parse_lines",
    "parse_ranks",
    "probability_lines",
    "rank_lines",
    "read_adjacency_kv",
    "read_documents_csv",
    "read_edges",
    "read_lines",
    "read_ranks_kv",
    "read_table",
    "word_edges",
    "write_adjacency_kv",
    "write_kv",
    "write_ranks_kv",
]
