"""The driver's parquet tables and the graphs derived from them.

There is no edge-list table in the test data, so two graphs are derived with
Spark from the given tables (their work grows with the tables):

* ``lineitem_edges``: every order line is an edge from its part to the part
  of the next line of the same order; the last line of an order points at a
  node of its own (``-1 - l_orderkey``), which has no out-links.
* ``word_edges``: the distinct bigrams of ``documents`` as ``word -> next``
  edges with STRING ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the derived graph (the oracle SQL uses the same ones).
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
MIN_SPLITS = 8  # a scan of fewer splits is dealt to all cores
TASK_BYTES = 32 << 20  # of a table's files: what a task takes that counts bigrams before the shuffle


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, tasks: int = 1) -> DataFrame:
    """Deal the rows of a scan of a few splits to all cores.  A file with one
    row group cannot be split, so a small table would be tokenised by one
    task; a scan of ``MIN_SPLITS`` splits or more (anything over about 1 GB)
    is returned as it is, however many cores there are, if those are at least
    ``tasks``; otherwise the rows are dealt to at least ``tasks`` tasks.
    Asking for the number of splits plans the scan and runs no job."""
    if df.rdd.getNumPartitions() >= max(MIN_SPLITS, tasks):
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, tasks))


def _file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder (Hadoop FileSystem)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def documents(spark: SparkSession, sf_dir: str, task_bytes: int | None = None) -> DataFrame:
    """``doc_id, text`` of the documents table (other columns are pruned).

    With ``task_bytes`` a task gets about so many bytes of its files, however
    large the table: for map-side combining, whose table grows with the
    distinct keys of a task."""
    tasks = 1 if task_bytes is None else -(-_file_bytes(spark, f"{sf_dir.rstrip('/')}/documents.parquet") // task_bytes)
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tasks)


def lineitem_edges(lineitem: DataFrame) -> DataFrame:
    """``src, dst`` BIGINT ids, one edge per line: to the part of the
    following line of its order, or to the order's end node.

    The window needs a shuffle on ``l_orderkey`` (a handful of lines per
    order).
    """
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    return (lineitem.select("l_orderkey", *LINE_ORDER)
            .select(F.col("l_partkey").alias("src"),
                    F.coalesce(F.lead("l_partkey").over(w), F.lit(-1) - F.col("l_orderkey")).alias("dst")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_edges(read_table(spark, sf_dir, "lineitem"))


def word_edges(counts: DataFrame) -> DataFrame:
    """``src, dst`` STRING: one edge per distinct bigram."""
    return counts.select(F.col("word").alias("src"), F.col("next_word").alias("dst"))
