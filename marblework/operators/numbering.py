"""Numbers of rows and running sums over whole tables, without a task that sees all rows.

Rows are sorted by ranges.  Each task adds up its own share as it passes, in
constant memory, and the table is written with those sums.  What the shares
before it hold is a scan over the totals of tasks, in levels: sums of 256
neighbours, of 256 such sums, and so on, so that no window has more rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marblework.sources.shared import written

#: Bits of a part's number that one level takes: 2**BITS rows of a window at most.
BITS, LEVELS = 8, 4


def before_parts(totals: DataFrame, part: str, total: str) -> DataFrame:
    """(part, before): the sum of ``total`` over all parts of lower number; numbers from 0, below 2**32."""
    level = totals.select(F.col(part).cast("long").alias("k0"), F.col(total).cast("long").alias("total"))
    out = level.select("k0")
    for i in range(LEVELS):
        block = F.shiftright(F.col(f"k{i}"), BITS)
        order = Window.partitionBy(block).orderBy(f"k{i}").rowsBetween(Window.unboundedPreceding, -1)
        own = level.select(f"k{i}", F.coalesce(F.sum("total").over(order), F.lit(0)).alias(f"b{i}"))
        out = out.withColumn(f"k{i}", F.shiftright(F.col("k0"), BITS * i)).join(own, f"k{i}")
        level = level.groupBy(block.alias(f"k{i + 1}")).agg(F.sum("total").alias("total"))
    return out.select(F.col("k0").alias(part), sum((F.col(f"b{i}") for i in range(1, LEVELS)), F.col("b0")).alias("before"))


def with_start(df: DataFrame, order: list[Column | str], size: Column, start: str = "start") -> DataFrame:
    """``df`` with the sum of ``size`` over all rows before each in the order; a null size counts as 0."""
    sized = df.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
    schema = T.StructType([*sized.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_within", T.LongType())])
    arrow = to_arrow_schema(schema)
    at = sized.columns.index("_size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(at)
            ends = pc.add(pc.cumulative_sum(sizes), so_far)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pc.subtract(ends, sizes)], schema=arrow)
            so_far = ends[-1].as_py() if batch.num_rows else so_far

    placed = written(sized.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    totals = placed.groupBy("_part").agg(F.sum("_size").alias("_total"))
    starts = before_parts(totals, "_part", "_total")
    return placed.join(starts, "_part").select(*df.columns, (F.col("before") + F.col("_within")).alias(start))
