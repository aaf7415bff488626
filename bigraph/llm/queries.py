"""The registered queries of the training-data operators.

Each applies its operator, with production parameters, to its whole table and
derives the contract's columns from the operator's output.  ``SQL`` holds the
DuckDB equivalents where SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bigraph.llm import (
    compression_bands,
    fill_in_middle,
    hnsw_dedup,
    html_bilstm,
    importance_bitslice,
    language_crf,
    lm_interpolation,
    minhash_bayes,
    mixing,
    packing,
    quality_nbsvm,
    suffix_pfp,
    toxicity_neighbours,
)
from bigraph.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary file lies (the same on every executor)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_minhash_bayes")
def op1(spark, sf_dir):
    return minhash_bayes.near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op3_mixing", mixing.mix_sql())
def op3(spark, sf_dir):
    m = mixing.mixed(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return m.select("doc_id", F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"),
                    F.col("__mix_target").alias("target"), (F.col("__mix_copies") * F.col("__mix_size")).alias("taken"))


@register("op4_suffix_pfp")
def op4(spark, sf_dir):
    return suffix_pfp.removal_digest(read_table(spark, sf_dir, "documents"))


@register("op5_compression_bands")
def op5(spark, sf_dir):
    return compression_bands.compression_verdicts(read_table(spark, sf_dir, "documents"))


@register("op7_packing")
def op7(spark, sf_dir):
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "padded_length")


@register("op8_quality_nbsvm")
def op8(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality_nbsvm.quality_scores(docs, quality_nbsvm.fit(docs, read_table(spark, sf_dir, "labels")))


@register("op9_lm_interpolation")
def op9(spark, sf_dir):
    return lm_interpolation.interpolated_scores(read_table(spark, sf_dir, "documents"))


@register("op10_hnsw_dedup")
def op10(spark, sf_dir):
    return hnsw_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@register("op2_language_crf")
def op2(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language_crf.languages(docs, language_crf.fit(docs))


@register("op6_html_bilstm")
def op6(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return html_bilstm.main_text(pages, html_bilstm.fit(pages))


@register("op13_fill_in_middle")
def op13(spark, sf_dir):
    return fill_in_middle.digests(fill_in_middle.output_pieces(read_table(spark, sf_dir, "documents")))


@register("op12_importance_bitslice")
def op12(spark, sf_dir):
    return importance_bitslice.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op11_toxicity_neighbours")
def op11(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return toxicity_neighbours.toxicity_scores(docs, toxicity_neighbours.fit(docs, read_table(spark, sf_dir, "labels")))
