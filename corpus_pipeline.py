"""A corpus pipeline over ``documents``: quality classifier, near-duplicates,
repeated substrings, mixing to target weights, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)``, works on all rows of ``docs`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.

Edge cases are those of the operators: NULL and empty texts pass through (the
classifier judges them like any text), repeated rows count each, an empty
table gives empty results, extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bigraph.llm import minhash_bayes, mixing, packing, quality_nbsvm, suffix_pfp
from bigraph.llm.common import read_table, shared_path
from bigraph.llm.queries import tokenizer_path

#: Similarity of near-duplicates in the pipeline; op1's own threshold binds its query only.
NEAR = (4, 5)

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts."""
    model = quality_nbsvm.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_nbsvm.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near-duplicates: documents
    whose sets of 5-word shingles have a similarity of 0.8 or more."""
    return minhash_bayes.keep_first(docs, threshold=NEAR)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out every passage of 100 bytes or more that occurs earlier;
    ``n_chars`` follows the text."""
    out = suffix_pfp.without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their weights."""
    return mixing.emit(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents laid into sequences of 2048 tokens, with their ids.

    Copies of a document share its ``doc_id``; ``copy`` tells them apart, as
    the place of the copy's first token in the whole stream."""
    pieces = packing.pack(docs, tokenizer_path(), packing.WINDOW)
    copy = F.col("sequence_id") * packing.WINDOW + F.col("offset") - F.col("start")
    return pieces.withColumn("ids_crc32", F.crc32("ids")).withColumn("copy", copy)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated substrings", repeated_text),
    ("mixing", mix),
    ("packing", pack),
]

#: A learned classifier decides what stays: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is a table in the shared
    folder."""
    docs = read_table(spark, sf_dir, "documents").select(*DOCUMENT)
    for name, stage in STAGES:
        path = shared_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
