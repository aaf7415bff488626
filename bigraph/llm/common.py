"""Helpers shared by the training-data operators: tables in the shared folder,
hash folds, unique row keys, chunked Arrow maps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from bigraph.session import delete_folder, new_folder

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the cluster's shared folder
    (``bigraph.session.close`` removes it)."""
    return new_folder(spark, f"llm-{tag}")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, changed if one of ``columns`` has it (in any letter case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of a table of links for each of its files.
FILE_ROWS = 1 << 18


def materialize(df: DataFrame, tag: str, partition_by: str | None = None, most: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends there, and a lost executor re-reads the table.

    ``most``: the rows of ``df`` (narrow ones) are known not to be more.  A
    table of few rows is then dealt to as few files, however many tasks have
    made it: each file costs a request or, on a local file system, processes
    that set its mode, and a task of every later read."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    if most is not None and (files := max(1, -(-most // FILE_ROWS))) < shuffle_partitions(spark):
        df = df.repartition(files)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_llm_path", None)
        if path is not None:
            delete_folder(t.sparkSession, path)


def fold(doc_id: Column | str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; NULL ids fall in fold NULL."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % F.lit(modulus)


def least_hashed(rows: DataFrame, n: int, group: str) -> DataFrame:
    """``group, id`` of the ``n`` ids with the least hash in each group;
    ``rows`` is ``group, id, h`` and may repeat ids.

    Only ids under the part of the hash range that holds about ``4 * n`` of the
    group's ids are shuffled, so what meets in a task does not grow with the
    table or its tasks.  One row per group is broadcast: groups are the labels
    of a model that the driver holds.
    """
    share = rows.groupBy(group).agg(
        F.least(F.lit(1.0), 4.0 * n / F.approx_count_distinct("id")).alias("share"))
    low = (rows.join(F.broadcast(share), group)
           .where(F.col("h").cast("double") / 2.0**64 + 0.5 <= F.col("share"))
           .select(group, "id", "h").distinct())
    least = Window.partitionBy(group).orderBy("h", "id")
    return low.withColumn("r", F.row_number().over(least)).where(F.col("r") <= n).select(group, "id")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Return what this Python worker has freed to the system.

    A worker lives on for later tasks, an executor has one or more for each
    core, and the C allocator keeps what large arrays held: without this,
    every worker stays as large as the largest step it has ever run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc's
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one record batch."""
    def run(batches):
        for b in batches:
            yield from fn(b)
            del b       # not held while the next one is read
            give_back()
    return df.mapInArrow(run, schema)


KEY = "__llm_key"


def keyed(docs: DataFrame, key: str, payload: str, name: str = KEY) -> tuple[DataFrame, bool]:
    """``docs`` with a unique, non-null BIGINT column ``name`` in document
    order, and whether it is the id itself.

    Usually the ids are unique and the key is the id.  A table with NULL or
    repeated ids gets ranks instead: rows ordered by id (NULL last), then by
    payload.  The rank is two passes of prefix sums over range partitions,
    not one task.  ``name`` must not be a column of ``docs`` (see
    :func:`fresh`).
    """
    # Copies of an id are combined map-side, so a hot id is one row per task.
    seen = docs.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if seen.where(F.col("id").isNull() | (F.col("n") > 1)).isEmpty():
        return docs.withColumn(name, F.col(key).cast("bigint")), True
    order = [F.col(key).asc_nulls_last(), F.col(payload).asc_nulls_first()]
    return materialize(with_rank(docs, order, name), "keyed"), False


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its 0-based rank in ``order``: range partitions, numbered
    inside by one pass, shifted by the prefix sums of the partition totals
    (one row per partition).  Rows equal in ``order`` are spread over
    partitions by a hash of their place in the input, so many copies of a row
    are no hot range; their order among each other is arbitrary."""
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    cols = df.columns
    pid_name, local_name, base_name, tie = (fresh(n, [*cols, name]) for n in ("_pid", "_local", "_base", "_tie"))

    def number(batches):
        from pyspark import TaskContext
        pid, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([pid] * b.num_rows, pa.int32()),
                 pa.array(range(n, n + b.num_rows), pa.int64())], names=[*cols, pid_name, local_name])
            n += b.num_rows

    # The place is written before it is sorted by, so a task that runs again
    # finds it unchanged.
    placed = materialize(df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id())), "placed")
    by = [*order, F.col(tie)]
    ordered = placed.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop(tie)
    schema = StructType([*df.schema, StructField(pid_name, IntegerType()), StructField(local_name, LongType())])
    local = materialize(ordered.mapInArrow(number, schema), "rank")
    discard(placed)
    base = partition_offsets(local.groupBy(F.col(pid_name).alias("_pid")).agg(F.count(F.lit(1)).alias("total")))
    base = base.select(F.col("_pid").alias(pid_name), F.col("base").alias(base_name))
    return (local.join(F.broadcast(base), pid_name)
            .withColumn(name, F.col(local_name) + F.col(base_name))
            .select(*cols, name))


def partition_offsets(totals: DataFrame) -> DataFrame:
    """``_pid, base``: sum of ``total`` over the partitions before ``_pid``.
    One row per partition of a table (bounded by the number of its tasks)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_pid", F.coalesce(F.sum("total").over(w), F.lit(0)).cast("bigint").alias("base"))
