"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import logging
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
_FOLDERS: dict[str, list[str]] = {}      # by application: what its operators have written to the shared folder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "bigraph") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable folder for per-round tables, setting it only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used.  Only a session whose master is ``local`` or ``local[...]`` (one
    process, where every folder is shared) gets a fresh one when nothing is
    set; anywhere else this raises.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared "
                "folder (HDFS/S3/...) to cut lineage between rounds")
        configured = tempfile.mkdtemp(prefix="bigraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the shared folder, registered for
    :func:`close`."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/bigraph-{tag}-{uuid.uuid4().hex}"
    return register_folder(spark, path)


def register_folder(spark: SparkSession, path: str) -> str:
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` (it keeps the partitioning), registered for
    :func:`close`."""
    out = df.checkpoint()
    file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        register_folder(df.sparkSession, file.get())
    return out


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder (Hadoop FileSystem of the path); whether it was there."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    mine = _FOLDERS.get(sc.applicationId, [])
    if path in mine:
        mine.remove(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True))


def close(spark: SparkSession) -> int:
    """Delete every table that operators of this application have written to
    the shared folder (rounds, layouts, intermediate tables) and return their
    number.  DataFrames that read them are lost, so write results first."""
    paths = list(_FOLDERS.get(spark.sparkContext.applicationId, []))
    return sum(delete_folder(spark, p) for p in paths)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors (``--py-files`` for a running
    session), for drivers that have it on their own path only."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="bigraph-ship-"), "bigraph.zip")    # the driver's; Spark sends it on
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
