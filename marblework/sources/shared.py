"""Folders that driver and executors share, and tables written there."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; where that is unset, below the warehouse on one machine (tests), an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    root = root if ":" in root else "file://" + os.path.abspath(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what is read from it is the same each time, and survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
