"""Small helpers that the operators share."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Words parted by ASCII white space, in a str.  ``bytes.split()`` cuts at the same characters.
SPACED_WORD = re.compile("[^\x20\x09-\x0d]+")


def ship(spark: SparkSession) -> None:
    """Sends the package to Python workers that could not import it: those of a session started elsewhere.

    Spark's own file server hands the archive to the executors.  Nothing is sent
    where PYTHONPATH or the working folder, which workers share, has the package.
    """
    root, name = os.path.split(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    sc = spark.sparkContext
    if os.path.isdir(root) and not any(p and os.path.realpath(p) == os.path.realpath(root) for p in places) and not any(x.startswith(f"{name}-") for x in sc._python_includes):
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), f"{name}-{uuid.uuid4().hex}"), "zip", root, name)
        sc.addPyFile(made)


def schema_of(df: DataFrame, columns: list[str], more: str) -> T.StructType:
    """The named columns of ``df``, then the DDL fields ``more``."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in (df.schema[c] for c in columns)] + T._parse_datatype_string(more).fields)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches some rows at a time, so that a worker never holds a whole batch as Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def map_batches(df: DataFrame, columns: list[str], more: str, fn: Callable[..., Iterable]) -> DataFrame:
    """``fn(*lists of columns after the first)`` gives a row of the fields ``more`` for each row, beside the first column.

    Rows pass in Arrow batches; nothing is shuffled and a lost task is repeated
    from its input.
    """
    ship(df.sparkSession)
    out = schema_of(df, columns[:1], more)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = list(fn(*(c.to_pylist() for c in batch.columns[1:])))
            cells = list(zip(*made, strict=True)) if made else [[] for _ in arrow.names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type)] + [pa.array(c, t.type) for c, t in zip(cells, list(arrow)[1:], strict=True)], schema=arrow)

    return df.select(*[df[c] for c in columns]).mapInArrow(run, out)


def map_rows(df: DataFrame, columns: list[str], more: str, fn: Callable[..., list]) -> DataFrame:
    """``fn(*values of the columns after the first)`` for each row, as the fields ``more`` beside the first column."""
    return map_batches(df, columns, more, lambda *lists: [fn(*row) for row in zip(*lists, strict=True)])


def filter_rows(df: DataFrame, column: str, keep: Callable[[str | None], bool]) -> DataFrame:
    """Rows whose ``column`` passes ``keep``, with all their columns as they are."""
    ship(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array([keep(x) for x in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def replace_text(df: DataFrame, column: str, fn: Callable[[str | None], str | None]) -> DataFrame:
    """All columns of ``df``, ``column`` rewritten by ``fn``."""
    ship(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            new = pa.array([fn(x) for x in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    return df.mapInArrow(run, df.schema)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one that the cluster names in spark.checkpoint.dir."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of the warehouse on one machine (tests), an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return root if ":" in root else "file://" + os.path.abspath(root)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps start from there.

    The files outlive lost executors, and a loop's plan stays short.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "step")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.parquet(path)
    out._step = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes the files of frames that ``cut`` wrote and that nothing will read again."""
    for df in frames:
        path = getattr(df, "_step", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def digest_text(column) -> object:
    """Hex SHA-256 of a string column in UTF-8."""
    return F.sha2(F.encode(column, "UTF-8"), 256)
