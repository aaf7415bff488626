"""Bigram counts over a growing folder of texts.

The batch operators are plain DataFrame functions, so the same code runs on a
streaming DataFrame: each new file is tokenised as it arrives and the counts
per ``(word, next_word)`` are kept in Spark's state store (partial aggregation
per micro-batch, state sharded by the same hash as the batch shuffle).  The
checkpoint location must be on shared storage, like any streaming query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bigraph.operators.bigrams import bigram_counts, bigrams


def bigram_counts_stream(spark: SparkSession, path: str, fmt: str = "text",
                         schema: str | None = None, text: str = "text",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``word, next_word, n`` over the files arriving in ``path``.

    ``fmt="text"``: each line is a document (as ``read_lines``).  Other formats
    (e.g. ``parquet``) need ``schema`` holding the ``text`` column.
    """
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        docs = reader.load(path).withColumnRenamed("value", text)
    else:
        if schema is None:
            raise ValueError("a schema is needed for a streaming file source")
        docs = reader.schema(schema).load(path)
    return bigram_counts(bigrams(docs, text=text))


def start_bigram_counts(counts: DataFrame, checkpoint_location: str, sink: str = "memory",
                        query_name: str = "bigram_counts", available_now: bool = False,
                        **options) -> StreamingQuery:
    """Start the counting query; ``complete`` mode re-emits the whole table
    (memory sink, tests), ``update`` mode emits changed rows to sinks that
    accept updates (console, Kafka, ...).  File sinks only append, so to keep
    the counts in Parquet/Delta use ``counts.writeStream.foreachBatch``."""
    mode = "complete" if sink == "memory" else "update"
    writer = (counts.writeStream.format(sink).outputMode(mode).queryName(query_name)
              .option("checkpointLocation", checkpoint_location))
    for k, v in options.items():
        writer = writer.option(k, v)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
