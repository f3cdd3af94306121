"""Writers. Tables go to Parquet; outputs whose formats require null fields to JSON that keeps them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    """JSON lines, null fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def single_json(df: DataFrame, path: str) -> None:
    """A small result (a manifest of limited length, one row of counts) as one file: for what ends in one row, or a top-k."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def by_repository(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet partitioned by repository: a file for each, and more for one with more rows than rows_per_file, whose rows are dealt
    over as many tasks (sizes are counted first; the join with them is on a table of one row per repository)."""
    sizes = df.groupBy("repo_full_name").agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("__files"))
    salted = df.join(sizes.withColumnRenamed("repo_full_name", "__r"), F.col("repo_full_name").eqNullSafe(F.col("__r"))).withColumn("__salt", F.pmod(F.xxhash64(*df.columns[:1], F.monotonically_increasing_id()), F.col("__files")))
    salted.repartition("repo_full_name", "__salt").drop("__r", "__files", "__salt").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("repo_full_name").parquet(path)


def append_cache(misses: DataFrame, path: str) -> None:
    """Adds (key, value) rows of computed misses to a cache table."""
    misses.write.mode("append").parquet(path)


def quarantine(parts: dict[str, DataFrame], path: str) -> None:
    """The parts of a gated table, each below its own folder."""
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
