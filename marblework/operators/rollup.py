"""Aggregations: generated roll-ups, value profiles, missingness, previews and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_METRICS = 30


def metrics(df: DataFrame, grain: list[str], exclude: list[str] = (), most: int = MAX_METRICS) -> list[str]:
    """Numeric columns outside the grain and the exclusions; decimals are numeric."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in grain and f.name not in exclude][:most]


def level(df: DataFrame, grain: list[str], exclude: list[str] = (), most: int = MAX_METRICS) -> DataFrame:
    """Sums of all metrics by the grain; without any metric, ``record_count``."""
    names = metrics(df, grain, exclude, most)
    grouped = df.groupBy(*grain)
    return grouped.agg(*[F.sum(m).alias(m) for m in names]) if names else grouped.agg(F.count("*").alias("record_count"))


def rollup(df: DataFrame, levels: dict[str, list[str]], exclude: list[str] = (), most: int = MAX_METRICS) -> dict[str, DataFrame]:
    """One table per level."""
    return {name: level(df, grain, exclude, most) for name, grain in levels.items()}


def rollup_once(df: DataFrame, levels: dict[str, list[str]], exclude: list[str] = (), most: int = MAX_METRICS) -> DataFrame:
    """All levels by grouping sets, one shuffle: ``level`` and every grain column, null where a level lacks it.

    The metrics are those outside all grains, so that levels stay comparable.
    """
    every = list(dict.fromkeys(c for g in levels.values() for c in g))
    names = metrics(df, every, exclude, most)
    aggs = [F.sum(m).alias(m) for m in names] or [F.count("*").alias("record_count")]
    sets = [[F.col(c) for c in g] for g in levels.values()]
    bits = {sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in g): name for name, g in levels.items()}
    which = F.grouping_id(*every)
    grouped = df.groupingSets(sets, *[F.col(c) for c in every]).agg(which.alias("_level"), *aggs)
    label = F.element_at(F.create_map(*[F.lit(x) for b, n in bits.items() for x in (b, n)]), F.col("_level").cast("int"))
    return grouped.select(label.alias("level"), *every, *(names or ["record_count"]))


def unpivoted(df: DataFrame, columns: list[str], row: str | None = None) -> DataFrame:
    """(column, value) rows of the columns as text, with the column ``row`` beside them if it is named."""
    names = [c for c in columns if c != row]
    beside = [F.col(f"`{row}`")] if row else []
    return df.select(*beside, *[F.col(f"`{c}`").cast("string").alias(c) for c in names]).unpivot([row] if row else [], names, "column", "value")


def profile_distinct(df: DataFrame, columns: list[str], error: float = 0.016) -> DataFrame:
    """(column, distinct_approx, nulls, distinct_ratio) in one pass over the table; nulls are exact, distinct counts within some ``error``."""
    aggs = [a for c in columns for a in (F.approx_count_distinct(c, error).alias(f"d_{c}"), F.count_if(F.col(c).isNull()).alias(f"n_{c}"))]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("distinct_approx"), F.col(f"n_{c}").alias("nulls")) for c in columns]))
    return one.select("rows", rows.alias("x")).select("x.*", F.round(F.col("x.distinct_approx") / F.nullif("rows", F.lit(0)), 6).alias("distinct_ratio"))


def sketches(df: DataFrame, by: list[str], columns: list[str], precision: int = 12) -> DataFrame:
    """(by, column, rows, nulls, sketch): one mergeable HyperLogLog sketch for each column of each group, to be stored.

    A sketch has 2**precision registers at most, whatever it counts; with 12 its
    standard error is 1.6 %.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    long = df.select(*by, each.alias("x")).select(*by, "x.column", "x.value")
    return long.groupBy(*by, "column").agg(F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.hll_sketch_agg("value", precision).alias("sketch"))


def merged_sketches(stored: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of fewer groups (``by`` and column), as if their rows had been read together."""
    return stored.groupBy(*by, "column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch"))


def sketched_profile(stored: DataFrame, by: list[str]) -> DataFrame:
    """(by, column, distinct_approx, nulls, distinct_ratio) from stored sketches; no table is read again."""
    count = F.hll_sketch_estimate("sketch")
    return merged_sketches(stored, by).select(*by, "column", count.alias("distinct_approx"), "nulls", F.round(count / F.nullif("rows", F.lit(0)), 6).alias("distinct_ratio"))


def top_values(df: DataFrame, columns: list[str], n: int = 20) -> DataFrame:
    """(column, value, count, pct, rank, truncated): the n most frequent non-null values of each column.

    All columns go through one grouping; only distinct values reach the ranking,
    which Spark limits per task before it shuffles.
    """
    counts = unpivoted(df, columns).groupBy("column", "value").agg(F.count("*").alias("count"))
    whole = counts.groupBy("column").agg(F.sum("count").alias("rows"))
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    ranked = counts.filter("value IS NOT NULL").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n + 1)
    more = ranked.groupBy("column").agg((F.max("rank") > n).alias("truncated"))
    return ranked.filter(F.col("rank") <= n).join(whole, "column").join(more, "column").select("column", "value", "count", F.round(F.col("count") * 100.0 / F.col("rows"), 2).alias("pct"), "rank", "truncated")


def missing_cells(df: DataFrame) -> DataFrame:
    """(column, rows, missing): null or blank cells of every column, however many there are, by one pass."""
    blank = lambda c: F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`").cast("string")) == "")
    one = df.agg(F.count("*").alias("_rows"), *[F.count_if(blank(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(df.columns)]))
    return one.select(F.col("_rows").alias("rows"), cells.alias("x")).select("x.column", "rows", "x.missing")


def missingness(df: DataFrame, most_columns: int = 200, top: int = 25) -> DataFrame:
    """(column, pct): share of null or blank cells of the first columns, highest first: a list to look at, not to infer rules from."""
    every = missing_cells(df.select(*[f"`{c}`" for c in df.columns[:most_columns]]))
    pct = F.round(F.col("missing") * 100.0 / F.greatest("rows", F.lit(1)), 4)
    return every.select("column", pct.alias("pct")).orderBy(F.desc("pct"), "column").limit(top)


def preview(df: DataFrame, n: int = 20) -> dict:
    """{"schema", "rows" (a DataFrame of at most n), "row_count", "truncated"}."""
    total = df.count()
    return {"schema": [(f.name, f.dataType.simpleString()) for f in df.schema], "rows": df.limit(n), "row_count": total, "truncated": total > n}


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key groups of more than one row, with their counts; null keys group too."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def outliers(df: DataFrame, columns: list[str], sigmas: float = 4.0, least: int = 10) -> DataFrame:
    """(column, n, outliers): values beyond ``sigmas`` sample deviations of their column's mean."""
    stats = df.agg(*[a for c in columns for a in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))])
    far = lambda c: F.count_if((F.col(f"n_{c}") >= least) & (F.abs(F.col(c) - F.col(f"m_{c}")) > sigmas * F.col(f"s_{c}")))
    one = df.crossJoin(F.broadcast(stats)).agg(*[x for c in columns for x in (F.count(c).alias(f"c_{c}"), far(c).alias(f"o_{c}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c_{c}").alias("n"), F.col(f"o_{c}").alias("outliers")) for c in columns]))
    return one.select(rows.alias("x")).select("x.*")


def status_summary(df: DataFrame, column: str = "status") -> DataFrame:
    """Counts by status."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def capped(df: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows, one row with ``truncated``): at most ``limit`` rows; 0 is no limit."""
    if not limit:
        return df, df.limit(0).agg(F.lit(False).alias("truncated"))
    return df.limit(limit), df.limit(limit + 1).agg((F.count("*") > limit).alias("truncated"))


def answer(df: DataFrame, limit: int) -> dict:
    """{"rows", "total_count", "truncated"}: the first ``limit`` rows, and how many there are, from one job.

    Every task keeps ``limit`` rows of its own, and all rows pass a counter on the
    way, so a sorted frame keeps its order.  The rows come to the driver: ``limit``
    is a number of rows to show.
    """
    if limit < 1:
        raise ValueError("limit must be 1 or more")
    counted, at = Observation(), "_at"
    while at in df.columns:
        at = "_" + at
    placed = df.withColumn(at, F.monotonically_increasing_id()).observe(counted, F.count(F.lit(1)).alias("total_count"))
    rows = placed.orderBy(at).limit(limit).drop(at).collect()
    total = counted.get["total_count"]
    return {"rows": rows, "total_count": total, "truncated": total > limit}
