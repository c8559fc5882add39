"""The three layers: user SQL over named DataFrames, written as Parquet, checked, gated."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marblework.functions import text as X
from marblework.operators.joins import union_years

#: Names under which a multi-year source is known to user SQL.
YEAR_VIEWS = ("source_input", "clean", "mart_input", "mart", "mart_all_years")


def run_sql(spark: SparkSession, sql: str, frames: dict[str, DataFrame], params: dict | None = None) -> DataFrame:
    """User SQL over DataFrames named ``{name}`` with ``:param`` values.

    A name or parameter that is not given is an error before anything runs.
    """
    X.register_sql(spark)
    lacking = sorted(set(re.findall(r"\{(\w+)\}", sql)) - set(frames))
    if lacking:
        raise ValueError(f"unresolved names: {lacking}")
    used = {k: v for k, v in frames.items() if "{" + k + "}" in sql}
    asked = set(re.findall(r"(?<![:\w]):([A-Za-z_]\w*)", re.sub(r"'[^']*'", "", sql)))
    if asked - set(params or {}):
        raise ValueError(f"unresolved parameters: {sorted(asked - set(params or {}))}")
    return spark.sql(sql, args={k: v for k, v in (params or {}).items() if k in asked} or None, **used)


def run_clean(raw: DataFrame, sql: str, params: dict | None = None, sample_rows: int | None = None) -> DataFrame:
    """The CLEAN select over ``{raw_input}``; a sample run takes so many of its rows."""
    out = run_sql(raw.sparkSession, sql, {"raw_input": raw}, params)
    return out.limit(sample_rows) if sample_rows else out


def run_mart(clean: DataFrame, tables: dict[str, str], support: dict[str, DataFrame] | None = None, params: dict | None = None) -> dict[str, DataFrame]:
    """The MART selects over ``{clean_input}`` and support tables."""
    return {name: run_sql(clean.sparkSession, sql, {"clean_input": clean} | (support or {}), params) for name, sql in tables.items()}


def run_mart_multi_year(by_year: dict[int, DataFrame], years: list[int], tables: dict[str, str], params: dict | None = None) -> dict[str, DataFrame]:
    """Selects over the union of the years, under any of YEAR_VIEWS; ``:years_csv`` lists them."""
    whole = union_years(by_year, years)
    given = {"years_csv": ",".join(map(str, years))} | (params or {})
    return {name: run_sql(whole.sparkSession, sql, dict.fromkeys(YEAR_VIEWS, whole), given) for name, sql in tables.items()}


def typed_projection(df: DataFrame, year: int | None = None) -> DataFrame:
    """The clean projection that the column types suggest; a year column is added if none is there."""
    by = {T.StringType: X.normalize_string, T.DoubleType: lambda c: c.cast("double"), T.FloatType: lambda c: c.cast("double")}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    out = []
    for f in df.schema:
        make = by.get(type(f.dataType)) or ((lambda c: c.cast("bigint")) if isinstance(f.dataType, whole) else lambda c: c)
        out.append(make(F.col(f"`{f.name}`")).alias(X.snake_name(f.name)))
    named = {X.snake_name(c) for c in df.columns}
    return df.select(*out, *([F.lit(year).alias("anno")] if year and not named & {"anno", "year"} else []))


def write_layer(df: DataFrame, path: str, partition_by: list[str] = (), mode: str = "overwrite") -> dict:
    """Writes Parquet with ZSTD and gives {"row_count", "column_count", "bytes"}: rows as the same job counted them, bytes of the folder's files."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0  # lengths come from the listing, contents are not read
    return {"row_count": seen.get["row_count"], "column_count": len(df.columns), "bytes": size}
