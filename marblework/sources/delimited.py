"""Delimited text to DataFrames: options, fixed schemas, ragged rows, bad rows, several files."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marblework.functions import text as X
from marblework.sources.heads import first_lines

CORRUPT, EXTRA = "_corrupt", "_extra"
#: Options of a read and the reader's names for them.
OPTIONS = {"delim": "sep", "sep": "sep", "encoding": "encoding", "quote": "quote", "escape": "escape", "comment": "comment", "dateformat": "dateFormat", "timestampformat": "timestampFormat", "header": "header", "max_line_size": "maxCharsPerColumn"}
#: Options that say how rows are taken and not how they are parsed.  ``parallel`` asks for nothing: Spark reads in parallel anyway.
HANDLED = {"nullstr", "columns", "skip", "decimal", "thousands", "trim", "null_padding", "ignore_errors", "strict_mode", "auto_detect", "parallel"}
#: Names of CP1252 and of ISO-8859-1, which is read as CP1252 because it has the same characters and fewer.
CP1252 = ("cp1252", "windows-1252", "windows1252", "win1252", "win-1252", "ansi", "latin1252", "latin1", "latin-1", "iso-8859-1", "iso8859-1")


def merged_options(defaults: dict, suggested: dict | None = None, config: dict | None = None) -> dict:
    """Options by precedence: the configuration over suggestions over defaults."""
    return {**defaults, **(suggested or {}), **(config or {})}


def is_cp1252(options: dict) -> bool:
    return str(options.get("encoding") or "").strip().lower() in CP1252


def reader_options(options: dict) -> dict:
    """The options under the reader's names; unknown ones are an error.

    CP1252 is read as ISO-8859-1 and set right by ``recoded``, which asks no
    charset of the session.
    """
    if unknown := set(options) - {*OPTIONS} - HANDLED:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    out = {OPTIONS[k]: v for k, v in options.items() if k in OPTIONS and v is not None}
    if is_cp1252(options):
        out["encoding"] = "ISO-8859-1"
    elif str(out.get("encoding", "")).lower() in ("utf8", "ascii"):
        out["encoding"] = {"utf8": "UTF-8", "ascii": "US-ASCII"}[out["encoding"].lower()]
    return out


def recoded(df: DataFrame, options: dict) -> DataFrame:
    """Names and text cells of a CP1252 read with their own characters; other reads as they are."""
    if not is_cp1252(options):
        return df
    return df.select(*[(X.latin1_to_cp1252(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(X.latin1_name(f.name)) for f in df.schema])


def read_mode(options: dict, mode: str | None) -> str:
    """``mode`` if it is given, else what the options ask for: robust to pad or to pass over bad rows, strict, or fallback."""
    if mode is not None:
        return mode
    if options.get("null_padding") or options.get("ignore_errors") or options.get("strict_mode") is False:
        return "robust"
    return "strict" if options.get("strict_mode") else "fallback"


def lines_after(spark: SparkSession, paths: list[str], n: int, options: dict) -> DataFrame:
    """(line): all lines but the first ``n`` of each file, blank ones dropped.

    A task sees a file's lines in order, split by split, so it drops them as they
    pass and nothing is shuffled.
    """
    raw = spark.read.text(paths).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, 0
        for batch in batches:
            while batch.num_rows:
                here = (batch.column(1)[0].as_py(), batch.column(2)[0].as_py())
                other = pc.index(pc.and_(pc.equal(batch.column(1), here[0]), pc.equal(batch.column(2), here[1])), False).as_py()
                size = batch.num_rows if other < 0 else other
                if here != now:
                    now, seen = here, 0
                drop = max(0, min(size, n - seen)) if here[1] == 0 else 0
                yield batch.slice(drop, size - drop).select([0])
                seen += size
                batch = batch.slice(size)

    kept = raw.mapInArrow(run, "value binary")
    line = F.decode("value", "ISO-8859-1") if is_cp1252(options) else F.col("value").cast("string")
    return kept.select(line.alias("line")).filter("trim(line) <> ''")


def header_names(spark: SparkSession, paths: list[str], options: dict) -> list[str]:
    """The header of the first file by name, below the lines that are skipped."""
    place = int(options.get("skip") or 0) + 1
    line = first_lines(spark, paths, place).filter(F.col("place") == place).orderBy("file").select("line").first()
    said = line["line"].removeprefix("\ufeff") if line else ""
    return next(csv.reader([said], delimiter=options.get("sep") or options.get("delim") or ",", quotechar=options.get("quote") or '"'), [])


def parse_columns(columns: dict[str, str]) -> list[tuple[str, str, str]]:
    """(raw name, clean name, type) of ``{raw: TYPE}`` or ``{raw: "clean:TYPE"}``."""
    out = []
    for raw, spec in columns.items():
        clean, _, kind = spec.rpartition(":")
        out.append((raw, clean or raw, {"VARCHAR": "STRING", "TEXT": "STRING"}.get(kind.upper(), kind.upper())))
    return out


def unmarked(c, options: dict):
    """A number's text without thousands marks and with a point for the decimal mark."""
    if options.get("thousands"):
        c = F.replace(c, F.lit(options["thousands"]), F.lit(""))
    if options.get("decimal", ".") != ".":
        c = F.replace(c, F.lit(options["decimal"]), F.lit("."))
    return c


def _typed(c, kind: str, options: dict):
    if kind == "STRING":
        return c
    if kind in ("INTEGER", "INT", "BIGINT", "DOUBLE", "FLOAT") or kind.startswith("DECIMAL"):
        c = unmarked(c, options)
    if kind in ("INTEGER", "INT"):
        return X.cast_int(c)
    if kind == "BIGINT":
        return X.cast_bigint(c)
    if kind in ("DOUBLE", "FLOAT"):
        return X.cast_double(c).cast(kind.lower())
    if kind == "DATE":
        return F.try_to_timestamp(c, F.lit(options["dateformat"])).cast("date") if options.get("dateformat") else F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), c.try_cast("date"))
    return c.try_cast(kind)


def nulls(df: DataFrame, marks: str | list[str] | None) -> DataFrame:
    """Text cells equal to one of the marks become null."""
    if not marks:
        return df
    marks = [marks] if isinstance(marks, str) else list(marks)
    return df.select(*[F.when(~F.col(f"`{f.name}`").isin(*marks), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def read_text_columns(spark: SparkSession, paths: list[str], names: list[str], options: dict) -> DataFrame:
    """All-text columns under ``names``, with EXTRA (a cell beyond them) and CORRUPT (the row, if it does not fit).

    ``header`` says whether a first row is skipped, ``skip`` how many lines stand before it.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, EXTRA, CORRUPT]])
    trim = str(bool(options.get("trim"))).lower()
    asked = reader_options(options) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreLeadingWhiteSpace": trim, "ignoreTrailingWhiteSpace": trim}
    skip = int(options.get("skip") or 0)
    if not skip:
        return recoded(spark.read.options(**asked, enforceSchema="true").schema(schema).csv(paths), options)
    lines = lines_after(spark, paths, skip + bool(options.get("header", True)), options)
    if comment := asked.get("comment"):
        lines = lines.filter(~F.col("line").startswith(comment))
    parse = {k: str(v) for k, v in asked.items() if k not in ("header", "encoding", "comment")}
    parsed = lines.select(F.from_csv("line", schema.toDDL(), parse).alias("x")).select("x.*")
    return recoded(parsed, options)


def inferred(df: DataFrame, options: dict) -> DataFrame:
    """Text columns as bigint, double or timestamp where every value reads as one, by one pass over the table."""
    kinds = {"BIGINT": lambda c: c.rlike(r"^[+-]?\d+$") & c.try_cast("bigint").isNotNull(), "DOUBLE": lambda c: X.cast_double(c).isNotNull(), "TIMESTAMP": lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$") & c.try_cast("timestamp").isNotNull()}
    names, plain = df.columns, []
    for i, n in enumerate(names):
        c = F.trim(F.col(f"`{n}`"))
        number = unmarked(c, options)
        plain += [F.count(c).alias(f"n_{i}"), *[F.count_if(~good(number if kind != "TIMESTAMP" else c)).alias(f"{kind}_{i}") for kind, good in kinds.items()]]
    seen = df.agg(*plain).first()
    return df.select(*[_typed(F.trim(F.col(f"`{n}`")), next((k for k in kinds if seen[f"n_{i}"] and not seen[f"{k}_{i}"]), "STRING"), options).alias(n) if seen[f"n_{i}"] else F.col(f"`{n}`") for i, n in enumerate(names)])


def read_csv(spark: SparkSession, paths: list[str], options: dict | None = None, mode: str | None = None) -> DataFrame:
    """Rows of delimited files.

    With ``columns`` the schema is fixed; otherwise it is inferred from the data,
    unless ``auto_detect`` is off.  ``strict`` raises on a row that does not fit,
    ``robust`` pads short rows with null and drops wide ones, ``fallback`` is
    strict if one counting pass finds nothing wrong and robust otherwise; the
    mode follows from the options where it is not given.
    """
    options = {"header": True} | (options or {})
    chosen = read_mode(options, mode)
    if not options.get("columns"):
        by_hand = options.get("decimal", ".") != "." or options.get("thousands") or options.get("skip")
        if not by_hand:
            read = spark.read.options(**reader_options(options)).option("inferSchema", str(options.get("auto_detect") is not False).lower()).option("mode", {"strict": "FAILFAST", "robust": "DROPMALFORMED" if options.get("ignore_errors") else "PERMISSIVE"}.get(chosen, "PERMISSIVE"))
            return nulls(recoded(read.csv(paths), options), options.get("nullstr"))
        names = header_names(spark, paths, options)
        names = names if options.get("header", True) else [f"_c{i}" for i in range(len(names))]
        as_text = read_csv(spark, paths, options | {"columns": {n: "VARCHAR" for n in names}}, chosen)
        as_text = as_text.toDF(*map(X.latin1_name, as_text.columns)) if is_cp1252(options) else as_text
        return as_text if options.get("auto_detect") is False else inferred(as_text, options)
    named = parse_columns(options["columns"])
    raw = read_text_columns(spark, paths, [n for n, _, _ in named], options)
    wide = F.col(EXTRA).isNotNull() & (F.col(EXTRA) != "")
    short = F.col(f"`{named[-1][0]}`").isNull() & F.col(CORRUPT).isNotNull()
    if chosen == "fallback":
        chosen = "robust" if raw.filter(wide | short).limit(1).count() else "strict"
    good = raw.filter(~wide | wide.isNull()) if chosen == "robust" else raw.withColumn(named[0][0], F.when(wide | short, F.raise_error(F.concat(F.lit("row does not fit: "), F.coalesce(CORRUPT, F.lit("")))).cast("string")).otherwise(F.col(f"`{named[0][0]}`")))
    cleaned = nulls(good.drop(EXTRA, CORRUPT), options.get("nullstr"))
    cell = lambda n: F.expr(f"trim(BOTH ' \t\r\n' FROM `{n}`)") if options.get("trim") else F.col(f"`{n}`")
    return cleaned.select(*[_typed(cell(raw_name), kind, options).alias(clean) for raw_name, clean, kind in named])


def bad_rows(spark: SparkSession, paths: list[str], options: dict) -> DataFrame:
    """(row): what a robust read drops."""
    named = parse_columns(options["columns"])
    raw = read_text_columns(spark, paths, [n for n, _, _ in named], options)
    return raw.filter(F.col(EXTRA).isNotNull() & (F.col(EXTRA) != "")).select(F.coalesce(CORRUPT, F.concat_ws(options.get("sep", options.get("delim", ",")), *[F.col(f"`{n}`") for n, _, _ in named], EXTRA)).alias("row"))


def read_padded(spark: SparkSession, paths: list[str], names: list[str], options: dict | None = None) -> DataFrame:
    """Text columns, short rows filled with ``''``, all trimmed; a wide row is an error that names it."""
    raw = read_text_columns(spark, paths, names, {"header": True} | (options or {}))
    bad = F.col(EXTRA).isNotNull() & (F.col(EXTRA) != "")
    message = F.concat(F.lit("row with too many fields: "), F.coalesce(CORRUPT, F.lit("")))
    first, *rest = names
    cell = lambda n: F.coalesce(F.trim(F.col(f"`{n}`")), F.lit(""))
    return raw.select(F.when(bad, F.raise_error(message).cast("string")).otherwise(cell(first)).alias(first), *[cell(n).alias(n) for n in rest])


def by_header(spark: SparkSession, paths: list[str], options: dict) -> list[DataFrame]:
    """The files as text, one DataFrame for each different header: the headers of all files come by one pass."""
    opts = {"header": True} | options
    heads = first_lines(spark, paths, 1).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    groups = sorted((r["files"] for r in heads.collect()), key=lambda files: files[0])
    return [recoded(spark.read.options(**reader_options(opts)).csv(files), opts) for files in groups]


def read_aligned(spark: SparkSession, paths: list[str], names: list[str], options: dict | None = None) -> DataFrame:
    """Text columns by header name in the given order; a missing one is ``''``, others are ignored.

    Each file keeps its own header: files with equal headers are read together,
    and the groups are united.
    """
    frames = []
    for df in by_header(spark, paths, options or {}):
        have = {c.strip(): c for c in df.columns}
        frames.append(df.select(*[F.coalesce(F.trim(F.col(f"`{have[n]}`")), F.lit("")).alias(n) if n in have else F.lit("").alias(n) for n in names]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def inject(df: DataFrame, constants: dict[str, dict[str, object]], file_column: str = "_file") -> DataFrame:
    """Constant columns per file name (exact match); files or columns that are not named get null.

    ``df`` has the file's name in ``file_column``, as from ``_metadata.file_name``.
    """
    names = sorted({c for v in constants.values() for c in v})
    out = df
    for name in names:
        value = None
        for file, cells in constants.items():
            if name in cells:
                hit = F.col(file_column) == file
                value = F.when(hit, F.lit(cells[name])) if value is None else value.when(hit, F.lit(cells[name]))
        out = out.withColumn(name, value)
    return out


def union_by_header(spark: SparkSession, paths: list[str], options: dict | None = None) -> DataFrame:
    """All files under the union of their headers, as text; columns in the order in which files by name bring them."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), by_header(spark, paths, options or {}))
