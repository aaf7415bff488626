"""The streaming bigram counts equal the batch counts over the same files."""

import os
import tempfile

from bigraph.operators import bigrams as B
from bigraph.sources import read_lines
from bigraph.streaming import bigram_counts_stream, start_bigram_counts


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="bigraph-stream-src-")
    ckpt = tempfile.mkdtemp(prefix="bigraph-stream-ckpt-")
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("my wife my dog\nthe dog and the cat\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("My Wife's dog\n")
    q = start_bigram_counts(bigram_counts_stream(spark, src, max_files_per_trigger=1), ckpt,
                            query_name="bigram_counts_test", available_now=True)
    q.awaitTermination(120)
    got = {(r.word, r.next_word): r.n for r in spark.table("bigram_counts_test").collect()}
    want = {(r.word, r.next_word): r.n for r in B.bigram_counts(B.bigrams(read_lines(spark, src))).collect()}
    assert got == want and got[("my", "wife")] == 1 and got[("my", "wifes")] == 1


def test_stream_over_parquet_documents(spark):
    """Documents arriving as Parquet files (the driver's table format)."""
    from bigraph.sources import documents

    src = tempfile.mkdtemp(prefix="bigraph-stream-pq-")
    ckpt = tempfile.mkdtemp(prefix="bigraph-stream-ckpt-")
    docs = documents(spark, "/root/testdata/sf0.001")
    docs.write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    stream = bigram_counts_stream(spark, os.path.join(src, "batch1"), fmt="parquet",
                                  schema="doc_id BIGINT, text STRING")
    q = start_bigram_counts(stream, ckpt, query_name="bigram_counts_pq", available_now=True)
    q.awaitTermination(180)
    got = {(r.word, r.next_word): r.n for r in spark.table("bigram_counts_pq").collect()}
    want = {(r.word, r.next_word): r.n for r in B.bigram_counts(B.bigrams(docs)).collect()}
    assert got == want
