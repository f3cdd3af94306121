"""Streams of landing files: the batch operators on unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import text as T


def landing(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files below a folder, as they come."""
    return spark.readStream.schema(schema).parquet(path)


def first_of_content(units: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """Exact duplicates dropped within the watermark; state is bounded by the delay. Rows with null text pass."""
    hashed = units.withColumn("content_hash", T.content_hash(T.normalize_code(F.col("code"))))
    return hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def counts(units: DataFrame, time: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Units per language and time window."""
    return units.withWatermark(time, delay).groupBy(F.window(time, window), "language").agg(F.count("*").alias("n"))
