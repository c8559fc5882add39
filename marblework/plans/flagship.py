"""CLEAN star join and its MART by region and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marblework.session import table

REGION_YEAR_SQL = """
SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_lines,
       round(sum(l_extendedprice * (1 - l_discount)), 1) AS revenue,
       round(avg(l_quantity), 2) AS avg_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
WHERE l_quantity IS NOT NULL
GROUP BY 1, 2
"""


def region_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined up to their region, then counted and summed by region and year.

    Lines are pre-aggregated by order before they meet orders, so the widest
    shuffle carries one row per order; the small dimensions join where Spark
    finds them small enough to broadcast.
    """
    t = lambda n: table(spark, sf_dir, n)
    per_order = (
        t("lineitem")
        .filter(F.col("l_quantity").isNotNull())
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.sum("l_quantity").alias("quantity"),
        )
    )
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return (
        per_order.join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", F.year("o_orderdate").alias("order_year"))
        .agg(
            F.sum("n_lines").alias("n_lines"),
            F.round(F.sum("revenue"), 1).alias("revenue"),
            F.round(F.sum("quantity") / F.sum("n_lines"), 2).alias("avg_quantity"),
        )
    )
