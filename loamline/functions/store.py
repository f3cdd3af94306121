"""Tables in the folder that all executors share: they cut lineages and survive the loss of executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir.

    Where that is unset, a session on this machine alone (local master: tests) gets a folder of its own, removed at the
    end; a cluster without a shared folder is an error, as its machines would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="loamline-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        root = "file://" + local
        spark.conf.set("spark.checkpoint.dir", root)
    _made.append(f"{root.rstrip('/')}/loamline-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> int:
    """Removes the folders that this process has made, once what was computed from them is written elsewhere; gives their number."""
    n = len(_made)
    while _made:
        remove(spark, _made.pop())
    return n


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark reports files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores before costly Python work, if the scan alone gives fewer tasks than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
