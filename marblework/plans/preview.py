"""What a delimited source looks like before it is taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marblework.functions.text import granularity, years_in
from marblework.operators import profile as P
from marblework.operators import quality as Q
from marblework.operators.joins import column_rows
from marblework.operators.rollup import unpivoted
from marblework.sources import delimited as D
from marblework.sources.heads import first_lines

#: Lines of each file that formats and quality are judged by, and rows that are shown.
HEAD, SHOWN = 1000, 5


def hints(spark: SparkSession, paths: list[str], lines: int = HEAD) -> dict:
    """Reader options of the first file by name, read from the first lines of each: encoding, sep, decimal, skip, robust."""
    head = first_lines(spark, paths, lines).select(F.col("file").alias("path"), F.col("place").alias("n"), F.col("line").cast("binary").alias("raw"))
    valid = head.groupBy("path").agg(F.when(F.min(F.is_valid_utf8("raw").cast("int")) == 1, "utf-8").otherwise("cp1252").alias("encoding"))
    text = head.select("path", "n", F.decode("raw", "ISO-8859-1").alias("line"))
    marks = P.delimiter(text)
    known = text.join(marks, "path")
    found = P.read_hints(valid, marks, P.decimal_mark(known), P.skip_lines(known), P.header_mismatch(known)).orderBy("path").first()
    return found["hints"].asDict() if found else {"encoding": "utf-8", "delimiter": ",", "decimal": None, "skip": 0, "robust": False}


def source_preview(spark: SparkSession, paths: list[str], name: str = "", lines: int = HEAD, shown: int = SHOWN) -> DataFrame:
    """One row: the format, the columns with types, kinds and roles, rows, a sample, the territorial level, the years and the quality.

    Formats and quality are judged by the first lines, as a preview is; rows,
    types and years come from whole files.
    """
    of = hints(spark, paths, lines)
    options = {"sep": of["delimiter"], "encoding": of["encoding"], "skip": of["skip"], "null_padding": of["robust"] or None}
    if of["decimal"] == ",":
        options |= {"decimal": ",", "thousands": "."}
    df = D.read_csv(spark, paths, options)
    names = df.columns
    numbered = df.withColumn("_n", F.monotonically_increasing_id())
    kinds = P.column_kinds(unpivoted(numbered, names, "_n").withColumnRenamed("_n", "n")).select(F.col("column").alias("name"), "kind", "normalize")
    columns = P.roles(column_rows(df)).join(kinds, "name", "left").agg(F.array_sort(F.collect_list(F.struct("name", "type", "role", "semantic_type", "kind"))).alias("columns"))
    sample = df.limit(shown).agg(F.collect_list(F.to_json(F.struct("*"))).alias("sample"))
    rows = df.agg(F.count("*").alias("row_count"))
    named = years_in(F.lit(" ".join(names)))
    dated = [c for c in names if P.is_year_name(c)]
    read = P.year_values(unpivoted(df, dated)).agg(F.min("low").alias("low"), F.max("high").alias("high")) if dated else rows.limit(0).agg(F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    head = first_lines(spark, paths, lines)
    first = head.groupBy("file").agg(F.count("*")).orderBy("file").limit(1).select("file")
    raw = head.join(F.broadcast(first), "file").filter(F.col("place") > of["skip"]).select((F.col("place") - of["skip"]).alias("n"), "line")
    ddl = ", ".join(f"c{i} STRING" for i in range(len(names)))
    cells = raw.filter("n > 1").select((F.col("n") - 1).alias("n"), F.from_csv("line", ddl, {"sep": of["delimiter"]}).alias("x")).select("n", "x.*")
    graded = Q.score(Q.checks(raw, cells, sampled=True, headers=names), sampled=True).select("structural", "semantic", "combined", "verdict")
    out = rows
    for part in (columns, sample, read, graded):
        out = out.crossJoin(F.broadcast(part))  # every side is one row
    level = granularity(F.lit(name), F.array(*map(F.lit, names)))
    return out.select(
        F.lit(of["encoding"]).alias("encoding"), F.lit(of["delimiter"]).alias("delimiter"), F.lit(of["decimal"]).alias("decimal"), F.lit(of["skip"]).alias("skip"), F.lit(of["robust"]).alias("robust"),
        "columns", "row_count", "sample", level.alias("level"), F.coalesce(named["low"], F.col("low")).alias("low"), F.coalesce(named["high"], F.col("high")).alias("high"), "structural", "semantic", "combined", "verdict",
    )
