"""Session settings that the library's functions rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings a session needs when it is built by this library.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(master: str = "local[*]", name: str = "marblework", **more: str) -> SparkSession:
    """A session with SETTINGS; ``more`` are further settings with ``__`` for dots."""
    b = SparkSession.builder.master(master).appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
