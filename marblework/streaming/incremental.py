"""Incremental landing: files that arrive are taken up once, by a stream that keeps its place.

The reference work is batch per dataset and year; what it does again and again
(take new files, leave old ones) is a stream with ``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def take_new(spark: SparkSession, source: str, schema, target: str, state: str, partition_by: list[str] = ()) -> None:
    """Appends the Parquet files of ``source`` that no earlier call took to ``target``; ``state`` keeps the place."""
    stream = spark.readStream.schema(schema).parquet(source)
    out = stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", target).trigger(availableNow=True)
    (out.partitionBy(*partition_by) if partition_by else out).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, by: list[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by time window; the same call on a stream drops what is later than ``late``."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")
