"""Connected components of a link table, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, release

#: Parts into which a join by a hot key is dealt.
PARTS = 8


def part_of(c: Column) -> Column:
    """The part that a row of the many-sided side of a join goes to."""
    return F.pmod(F.xxhash64(c), F.lit(PARTS)).cast("int")


def for_parts(df: DataFrame) -> DataFrame:
    """``df``, with few rows of each key, once for each part.

    Joined by key and ``part``, an aggregate reaches the join through an exchange
    of its own, and a hot key is dealt to PARTS tasks, which Spark splits further.
    """
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b), written: the least node that it reaches.

    Large-star and small-star rounds: every node's larger neighbours, then its
    smaller ones, are linked to its least neighbour, until the links are stars:
    no node has two smaller neighbours, or both smaller and larger ones.  The
    number of rounds grows with the logarithm of the longest path.

    Links with a null end and links of a node to itself are dropped, repeated
    links count once, and no link gives no row.
    """
    links = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    while True:
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x")).select("x.*")
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).filter("up > 1 OR up > 0 AND down > 0").isEmpty():
            out = cut(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
            release(links)
            return out
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.withColumn("part", part_of(F.col("b"))).join(for_parts(least), ["a", "part"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        each = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        new = cut(large.withColumn("part", part_of(F.col("b"))).join(for_parts(small), ["a", "part"]).select(each.alias("x")).select("x.*").filter("a > b").distinct())
        release(links)
        links = new
