"""Joins with support tables, hubs and bridges, and set operations over years and files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marblework.functions.text import HUB_NORMALIZERS, match_key


def register_support(support: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Names for user SQL: ``NAME_mart``, ``NAME_mart_TABLE``, ``NAME_clean`` for each support table given."""
    return {f"{name}_{part.replace('.', '_')}": df for name, parts in support.items() for part, df in parts.items()}


def join_support(facts: DataFrame, support: DataFrame, on: list[str]) -> DataFrame:
    """Facts with their support row; Spark broadcasts the support table where its size is known to be small."""
    return facts.join(support, on, "left")


def best_normalizer(df: DataFrame, column: str, hub: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(normalizer, matched): how many distinct values meet the hub under each normaliser, best first.

    Distinct values are taken before normalising, so the join is as wide as the
    column's vocabulary and not as the table.
    """
    values = df.select(F.col(column).cast("string").alias("v")).filter("v IS NOT NULL").distinct()
    forms = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("normalizer"), HUB_NORMALIZERS[n](F.col("v")).alias("k")) for i, n in enumerate(names)]))
    keys = hub.select(F.col(key).cast("string").alias("k")).distinct()
    found = values.select("v", forms.alias("f")).select("v", "f.*").join(keys, "k", "left_semi").groupBy("place", "normalizer").agg(F.count("*").alias("matched"))
    every = values.sparkSession.createDataFrame(list(enumerate(names)), "place int, normalizer string")
    return every.join(found, ["place", "normalizer"], "left").select("place", "normalizer", F.coalesce("matched", F.lit(0).cast("long")).alias("matched"))


def join_hub(df: DataFrame, column: str, hub: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Equi-join under the normaliser that matches the most distinct values; ties go to the first named."""
    best = best_normalizer(df, column, hub, key, names).orderBy(F.desc("matched"), "place").first()["normalizer"]
    return df.join(hub, HUB_NORMALIZERS[best](df[column]) == hub[key].cast("string"))


def join_bridge(df: DataFrame, on: str, bridge: DataFrame, bridge_on: str, bridge_to: str, target: DataFrame, target_key: str) -> DataFrame:
    """Two hops: the dataset to the bridge, the bridge to the target."""
    return df.join(bridge, df[on] == bridge[bridge_on]).join(target, bridge[bridge_to] == target[target_key])


def unmatched(required: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Required rows that are not present."""
    return required.join(present, on, "left_anti")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows under the union of the columns, missing ones null; column order of first appearance."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_years(by_year: dict[int, DataFrame], years: list[int], views: tuple[str, ...] = ()) -> DataFrame:
    """The union of the years asked for; a missing year is an error.  ``views`` are names to expose it under."""
    lacking = [y for y in years if y not in by_year]
    if lacking:
        raise ValueError(f"no data for {lacking}")
    whole = union_by_name([by_year[y] for y in years])
    for name in views:
        whole.createOrReplaceTempView(name)
    return whole


def merge_prefer(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """All of ``first``, and what ``second`` has besides."""
    return first.unionByName(second.join(first.select(*on).distinct(), on, "left_anti"))


def column_rows(df: DataFrame) -> DataFrame:
    """(name, type) of each column, from the schema alone."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema], "name string, type string")


def diff_columns(columns: DataFrame, year: str = "year", column: str = "column") -> DataFrame:
    """(from_year, to_year, added, removed) of consecutive years of a (year, column) table."""
    per = columns.groupBy(year).agg(F.collect_set(column).alias("now"))
    order = Window.orderBy(year)  # one row per year
    both = per.select(F.lag(year).over(order).alias("from_year"), F.col(year).alias("to_year"), F.lag("now").over(order).alias("before"), "now")
    return both.filter("from_year IS NOT NULL").select("from_year", "to_year", F.array_sort(F.array_except("now", "before")).alias("added"), F.array_sort(F.array_except("before", "now")).alias("removed"))


def diff_layers(source: DataFrame, target: DataFrame) -> DataFrame:
    """(key, change, from_type, to_type) between two (name, type) tables; ``change`` is added, removed, retyped or same."""
    side = lambda df, t: df.select(match_key(F.col("name")).alias("key"), F.col("type").alias(t)).dropDuplicates(["key"])
    both = side(source, "from_type").join(side(target, "to_type"), "key", "full")
    change = F.when(F.col("from_type").isNull(), "added").when(F.col("to_type").isNull(), "removed").when(F.col("from_type") != F.col("to_type"), "retyped").otherwise("same")
    return both.select("key", change.alias("change"), "from_type", "to_type")


def row_delta(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (source_rows, target_rows, row_delta); of Parquet tables Spark reads the footers only, no column."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    both = count(source, "source_rows").crossJoin(count(target, "target_rows"))  # one row each
    return both.withColumn("row_delta", F.col("target_rows") - F.col("source_rows"))


def diff_tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """``diff_layers`` of two tables, each change beside both row counts and their difference."""
    return diff_layers(column_rows(source), column_rows(target)).crossJoin(F.broadcast(row_delta(source, target)))  # the counts are one row
