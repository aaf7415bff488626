"""Structured Streaming use of the bigram operators."""

from bigraph.streaming.bigrams import bigram_counts_stream, start_bigram_counts

__all__ = ["bigram_counts_stream", "start_bigram_counts"]
