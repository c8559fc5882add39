"""Landed files as rows: manifests, sanity checks, selection, versions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marblework.sources.heads import located

#: Where published files are read by HTTPS, and what the clean layer reads.
HTTPS_STORE = "https://storage.googleapis.com/"
SUPPORTED = (".csv", ".tsv", ".txt", ".parquet", ".csv.gz", ".tsv.gz", ".txt.gz", ".nt.gz", ".xlsx", ".xls")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, modified, bytes); contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def write_each(rows: DataFrame, path: str, value: str = "value", folders: int = 128) -> None:
    """Each row's text and a line end as a file of its own, dealt in equal shares to that many folders below ``path``.

    A folder is written by one task and listed by one task; names and contents are the same however often a
    task runs.  Where Python cannot open a store, Spark's writer does it.
    """
    dealt = rows.select(F.coalesce(F.col(value).cast("string"), F.lit("")).alias("value")).repartition(folders).sortWithinPartitions("value")
    try:
        system, place = located(path)
        system.create_dir(place, recursive=True)
    except (OSError, pa.ArrowException, ValueError):
        dealt.withColumn("folder", F.spark_partition_id()).write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = located(path)
        own, n = f"{place}/folder={TaskContext.get().partitionId()}", 0
        for batch in batches:
            for text in batch.column(0):
                if not n:
                    system.create_dir(own, recursive=True)
                with system.open_output_stream(f"{own}/part-{n:08d}.txt", buffer_size=0) as out:
                    out.write(text.as_py().encode() + b"\n")
                n += 1
            yield batch.slice(0, 0)

    dealt.mapInArrow(run, dealt.schema).write.format("noop").mode("overwrite").save()


def manifest(spark: SparkSession, path: str, origin: str, source: str) -> DataFrame:
    """(name, bytes, sha256, origin, source) of each file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.lit(origin).alias("origin"), F.lit(source).alias("source"))


def problems(name: Column, content: Column) -> Column:
    """array of what is wrong with a landed file: empty, binary, html, tiny, one line."""
    start = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    odd = F.length(F.regexp_replace(start, r"[\x09\x0A\x0D\x20-\x7E\x80-\xFF]", ""))
    text = F.lower(name).rlike(r"\.(csv|tsv|txt|json|xml)$")
    html = F.lower(F.ltrim(start)).rlike(r"^(<!doctype html|<html)")
    size = F.length(content)
    return F.filter(
        F.array(
            F.when(size == 0, "empty"),
            F.when(text & (size > 0) & (start.contains("\x00") | (odd * 10 >= F.length(start))), "binary"),
            F.when(F.lower(name).endswith(".csv") & html, "html"),
            F.when((size > 0) & (size < 200), "tiny"),
            F.when(text & (size > 0) & ~F.decode(content, "ISO-8859-1").contains("\n"), "one line"),
        ),
        lambda x: x.isNotNull(),
    )


def select_inputs(files: DataFrame, mode: str = "latest", globs: list[str] | None = None) -> DataFrame:
    """The input files of a listing: ``explicit`` globs, ``latest``, ``largest`` or ``all``; ties by the lower name."""
    good = files.filter((F.col("bytes") > 0) & F.lower("name").rlike("(" + "|".join(e.replace(".", r"\.") for e in SUPPORTED) + ")$"))
    if mode == "all":
        return good
    if mode == "explicit":
        patterns = ["^" + "".join({"*": "[^/]*", "?": "[^/]"}.get(ch, "\\Q" + ch + "\\E") for ch in g) + "$" for g in globs or []]
        return good.filter(F.col("name").rlike("|".join(patterns)))
    by = {"latest": "modified", "largest": "bytes"}[mode]
    return good.orderBy(F.desc(by), F.lower("name")).limit(1)


def primary(outputs: DataFrame, by: list[str]) -> DataFrame:
    """The primary output of each source: the flagged one, else the first."""
    rest = [c for c in outputs.columns if c not in by]
    return outputs.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(~F.col("primary"), "position")).alias("x")).select(*by, "x.*")


def published(files: DataFrame, url: str = "url") -> DataFrame:
    """``files`` with object-store URLs in the form that any HTTPS client reads; others as they are."""
    c = F.col(url)
    return files.withColumn(url, F.when(c.startswith("s3://"), F.concat(F.lit(HTTPS_STORE), F.substring(c, 6, 2147483647))).otherwise(c))


def versioned(existing: DataFrame, landed: DataFrame, name: str = "name") -> DataFrame:
    """``landed`` with the version that each file gets beside those that exist (0 for a new name)."""
    top = existing.groupBy(name).agg(F.max("version").alias("_top"))
    rank = F.row_number().over(Window.partitionBy(name).orderBy(*[c for c in landed.columns if c != name]))
    return landed.withColumn("_r", rank).join(top, name, "left").withColumn("version", F.coalesce(F.col("_top"), F.lit(-1)) + F.col("_r")).drop("_top", "_r")


def for_year(sources: DataFrame, year: int) -> DataFrame:
    """Sources that a year uses, with ``{year}`` and the year's suffix put into their URLs.

    ``sources`` has (name, year, url, url_suffix_by_year map).
    """
    url = F.replace("url", F.lit("{year}"), F.lit(str(year)))
    suffix = F.coalesce(F.try_element_at("url_suffix_by_year", F.lit(year)), F.lit(""))
    return sources.filter(F.col("year").isNull() | (F.col("year") == year)).select("name", F.concat(url, suffix).alias("url"))
