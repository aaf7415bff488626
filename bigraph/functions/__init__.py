"""Column-level building blocks (pure Spark expressions)."""

from bigraph.functions.collect import (
    DEFAULT_MAX_ENTRIES,
    hot_keys,
    n_parts,
    part_of,
    sorted_entries_text,
    sorted_list_text,
    with_group_totals,
)
from bigraph.functions.text import adjacent_pairs, bigram_key, normalize_text, tokenize

__all__ = [
    "DEFAULT_MAX_ENTRIES",
    "adjacent_pairs",
    "bigram_key",
    "hot_keys",
    "n_parts",
    "normalize_text",
    "part_of",
    "sorted_entries_text",
    "sorted_list_text",
    "tokenize",
    "with_group_totals",
]
