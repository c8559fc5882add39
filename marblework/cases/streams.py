"""Streams over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.cases.sources import folder, landed
from marblework.registry import query
from marblework.session import table
from marblework.streaming import incremental as I


@query("stream_take_new", "SELECT count(*) AS n, count(DISTINCT s_suppkey) AS keys FROM supplier")
def _(spark, sf_dir):
    source = landed(spark, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), kind="parquet")
    target, state = folder(spark), folder(spark)
    for _ in range(2):  # the second call finds nothing new
        I.take_new(spark, source, "s_suppkey long, s_name string", target, state)
    return spark.read.parquet(target).agg(F.count("*").alias("n"), F.count_distinct("s_suppkey").alias("keys"))


@query("stream_windowed_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf_dir):
    return I.windowed_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"]).withColumn("start", F.col("start").cast("timestamp_ntz"))
