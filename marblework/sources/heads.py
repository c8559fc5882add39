"""The first lines of many files, read no further than asked.

The files are listed by Spark, which opens none of them; each task then opens its
own and stops after the lines that are wanted, so the bytes read grow with the
number of files and not with their size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes that are read at once.
CHUNK = 1 << 16
_MARK = b"\xef\xbb\xbf"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of a path as Spark writes it, and the place there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path).replace("s3a://", "s3://", 1))


def opened(path: str):
    """A stream of the file's bytes, decompressed by its name's ending."""
    system, place = located(path)
    return system.open_input_stream(place, compression="detect", buffer_size=0)


def head(stream, n: int, chunk: int = CHUNK) -> list[bytes]:
    """The first n lines of a stream; a line ends at LF, CR or both, and a mark before the first is no part of it."""
    got, lines = b"", []
    while len(lines) <= n:  # one more than asked, as the last may go on
        more = stream.read(chunk)
        if not more:
            break
        got += more
        # a CR at the end may be half of a line end
        lines = got[: -1 if got.endswith(b"\r") else None].splitlines()
    return got.removeprefix(_MARK).splitlines()[:n]


def first_lines(spark: SparkSession, paths: list[str], n: int) -> DataFrame:
    """(file, place, line): the first ``n`` lines of each file, place from 1; ``file`` is its plain path, as readers take it.

    Where Python cannot open a store's files, Spark reads them whole instead.
    """
    files = spark.read.format("binaryFile").load(paths).select("path")
    try:
        if one := files.first():
            with opened(one["path"]) as stream:
                stream.read(1)
    except (OSError, pa.ArrowException, ValueError):
        return _by_spark(spark, paths, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as stream:
                    lines = head(stream, n)
                yield pa.RecordBatch.from_arrays([pa.array([unquote(path)] * len(lines), pa.string()), pa.array(range(1, len(lines) + 1), pa.int32()), pa.array(lines, pa.binary())], names=["file", "place", "line"])

    return files.mapInArrow(run, "file string, place int, line binary").withColumn("line", F.col("line").cast("string"))


def _by_spark(spark: SparkSession, paths: list[str], n: int) -> DataFrame:
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("_at"))
    plain = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    return lines.filter("start = 0").withColumn("place", place).filter(F.col("place") <= n).select(plain.alias("file"), "place", "line")
