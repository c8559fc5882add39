"""Data-quality rules: all rules of a table are one aggregate."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marblework.functions.text import snake_name

RESULT = "rule string, column string, bad_rows long, severity string, message string"
#: Names that promise numbers.
NUMERIC_NAMES = (
    r"^(importo|valore|totale|tot|ammontare|costo|spesa|entrata|gettito|prezzo)$",
    r"^(percentuale|pct|tasso|aliquota|quota|indice|media|ratio)$",
    r"^(anno|annualit[aà])$",
    r".*(importo|valore|spesa|entrata|costo|percentuale|pct|totale|ammontare)$",
)


@dataclass
class Rules:
    """What a table must satisfy."""

    required: list[str] = field(default_factory=list)
    min_rows: int = 1
    not_null: list[str] = field(default_factory=list)
    primary_key: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    max_null_pct: dict[str, float] = field(default_factory=dict)
    types_by_name: bool = True

    def relaxed(self) -> Rules:
        """The rules of a sample run: the number of rows says nothing."""
        return Rules(self.required, 0, self.not_null, self.primary_key, self.ranges, self.max_null_pct, self.types_by_name)


def evaluate(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule and column: rule, column, bad_rows, severity, message.

    Counts come from one pass; the key check is one more grouping.  A rule on an
    absent column is a warning.  NaN lies outside every range.
    """
    spark, has = df.sparkSession, set(df.columns)
    fixed: list[tuple] = [("required_columns", c, int(c not in has), "error", f"missing column {c}") for c in rules.required]
    counted: list[tuple[str, str, Column, str]] = []
    rows = F.count(F.lit(1))

    def each(rule: str, columns, bad) -> None:
        for c in columns:
            if c not in has:
                fixed.append((rule, c, 1, "warning", f"{rule}: no column {c}"))
            else:
                counted.append((rule, c, bad(c), "error"))

    counted.append(("min_rows", "", F.greatest(F.lit(0), rules.min_rows - rows), "error"))
    each("not_null", rules.not_null, lambda c: F.count_if(F.col(c).isNull()))

    def outside(c: str) -> Column:
        low, high = rules.ranges[c]
        tests = [F.isnan(F.col(c).cast("double"))] + ([F.col(c) < low] if low is not None else []) + ([F.col(c) > high] if high is not None else [])
        return F.count_if(F.col(c).isNotNull() & reduce(lambda a, b: a | b, tests))

    each("range", rules.ranges, outside)
    each("max_null_pct", rules.max_null_pct, lambda c: F.when(F.count_if(F.col(c).isNull()) * 100.0 > rules.max_null_pct[c] * rows, F.count_if(F.col(c).isNull())).otherwise(0))
    if rules.types_by_name:
        fixed += [("type_by_name", c, 1, "warning", f"{c} looks numeric and is not") for c in badly_typed(df)]
    one = df.agg(*[bad.cast("long").alias(f"_{i}") for i, (_, _, bad, _) in enumerate(counted)])
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"_{i}").alias("bad_rows"), F.lit(s).alias("severity"), F.concat(F.lit(f"{r} {c}: "), F.col(f"_{i}").cast("string")).alias("message")) for i, (r, c, _, s) in enumerate(counted)]))
    out = one.select(cells.alias("x")).select("x.*")
    if rules.primary_key:
        if set(rules.primary_key) <= has:
            name = ",".join(rules.primary_key)
            groups = df.groupBy(*rules.primary_key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("bad_rows"))
            out = out.unionByName(groups.select(F.lit("primary_key").alias("rule"), F.lit(name).alias("column"), "bad_rows", F.lit("error").alias("severity"), F.concat(F.lit(f"primary_key {name}: "), F.col("bad_rows").cast("string")).alias("message")))
        else:
            fixed.append(("primary_key", ",".join(rules.primary_key), 1, "warning", "primary_key: absent column"))
    return out.unionByName(spark.createDataFrame(fixed, RESULT)) if fixed else out


def badly_typed(df: DataFrame) -> list[str]:
    """Columns whose names promise numbers and whose types are not numeric."""
    return [f.name for f in df.schema if any(re.match(p, f.name, re.I) for p in NUMERIC_NAMES) and not isinstance(f.dataType, T.NumericType)]


def inferred_not_null(missing: DataFrame, clean: list[str]) -> list[str]:
    """Clean columns whose raw column, by snake name, missed no value.

    ``missing`` has (column, rows, missing) of every raw column; a column that it
    does not name, or of a table without rows, is not inferred.
    """
    full = missing.filter("missing = 0 AND rows > 0").select("column").toLocalIterator()  # one row per column
    names = {snake_name(r["column"]) for r in full}
    return [c for c in clean if c in names]


def report(results: DataFrame, first: int = 20) -> DataFrame:
    """One row: passed, errors, warnings, score, grade, messages."""
    bad = F.col("bad_rows") > 0
    counts = results.agg(
        F.count_if(bad & (F.col("severity") == "error")).alias("errors"),
        F.count_if(bad & (F.col("severity") == "warning")).alias("warnings"),
        F.slice(F.array_sort(F.collect_list(F.when(bad, F.col("message")))), 1, first).alias("messages"),
    )
    score = quality_score(F.col("errors"), F.col("warnings"))
    return counts.select((F.col("errors") == 0).alias("passed"), "errors", "warnings", score.alias("score"), grade(score).alias("grade"), "messages")


def quality_score(errors: Column, warnings: Column) -> Column:
    """100, less 20 per error and 5 per warning, not below 0."""
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - 20 * errors - 5 * warnings)).cast("int")


def grade(score: Column) -> Column:
    return F.when(score >= 80, "good").when(score >= 50, "acceptable").otherwise("poor")


def passes(result: DataFrame, strict: bool = True) -> bool:
    """The gate before the next layer: strict stops on errors, else errors only warn."""
    return not strict or bool(result.select("passed").first()[0])


def transition(source_rows: Column, target_rows: Column, max_drop_pct: float, severity: str = "warning") -> Column:
    """struct<drop_pct, bad, severity>: the share of rows lost between layers against its limit."""
    drop = F.round((source_rows - target_rows) * 100.0 / F.nullif(source_rows, F.lit(0)), 2)
    return F.struct(drop.alias("drop_pct"), F.coalesce(drop > max_drop_pct, F.lit(False)).alias("bad"), F.lit(severity).alias("severity"))


def lost_columns(layers: DataFrame) -> DataFrame:
    """One row (removed, added, bad) from a diff of layers: more columns went than came."""
    return layers.agg(F.count_if(F.col("change") == "removed").alias("removed"), F.count_if(F.col("change") == "added").alias("added")).withColumn("bad", F.col("removed") > F.col("added"))


def promotion(raw_profile: DataFrame, clean_profile: DataFrame) -> DataFrame:
    """(dataset, has_raw, row_pct, column_pct): what of the raw layer the clean one keeps; profiles are (dataset, rows, columns)."""
    r, c = raw_profile.alias("r"), clean_profile.alias("c")
    part = lambda x: F.round(F.col(f"c.{x}") * 100.0 / F.nullif(F.col(f"r.{x}"), F.lit(0)), 2)
    return c.join(r, "dataset", "left").select("dataset", F.col("r.rows").isNotNull().alias("has_raw"), part("rows").alias("row_pct"), part("columns").alias("column_pct"))


def required_tables(declared: list[str], ruled: list[str], present: DataFrame) -> DataFrame:
    """(table, problem): declared tables that are absent, and rules for tables that nobody declares; ``present`` has (table)."""
    spark = present.sparkSession
    want = spark.createDataFrame([(t,) for t in declared], "table string")
    lost = want.join(present.select("table"), "table", "left_anti").withColumn("problem", F.lit("missing"))
    orphans = spark.createDataFrame([(t,) for t in ruled], "table string").join(want, "table", "left_anti").withColumn("problem", F.lit("orphan rule"))
    return lost.unionByName(orphans)


def suggested(df: DataFrame) -> DataFrame:
    """One row (min_rows, required): half the rows, at least one, and the first five columns."""
    return df.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / 2)).cast("long").alias("min_rows")).withColumn("required", F.array(*map(F.lit, df.columns[:5])))


def bad_names(columns: DataFrame, name: str = "name") -> DataFrame:
    """Columns not in lower case with underscores."""
    return columns.filter(~F.col(name).rlike("^[a-z][a-z0-9_]*$"))


def rule_coverage(columns: DataFrame, covered: DataFrame, name: str = "name") -> DataFrame:
    """One row (pct, ok): the share of columns under a rule; 80 is enough."""
    have = covered.select(name).distinct().withColumn("_c", F.lit(1))
    pct = F.round(F.count("_c") * 100.0 / F.count(F.lit(1)), 2)
    return columns.select(name).distinct().join(have, name, "left").agg(pct.alias("pct")).withColumn("ok", F.col("pct") >= 80)


def incoherent(runs: DataFrame, outputs: DataFrame, on: list[str]) -> DataFrame:
    """Runs that say SUCCESS without their output."""
    return runs.filter(F.col("status") == "SUCCESS").join(outputs, on, "left_anti")
