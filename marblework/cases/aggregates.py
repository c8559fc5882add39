"""Roll-ups, value profiles and counts over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import rollup as A
from marblework.registry import query
from marblework.session import table
from marblework.sources.shared import written


def _placed(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", F.round("c_acctbal").cast("long").alias("balance"), "c_nationkey")


@query("agg_hierarchy", "SELECT n_name, CAST(sum(CAST(round(c_acctbal) AS BIGINT)) AS BIGINT) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(spark, sf_dir):
    return A.rollup(_placed(spark, sf_dir), {"nation": ["n_name"], "region": ["r_name"]}, exclude=["c_nationkey"])["nation"]


@query("agg_hierarchy_once", "WITH p AS (SELECT r_name, n_name, CAST(round(c_acctbal) AS BIGINT) AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) SELECT 'nation' AS level, r_name, n_name, CAST(sum(b) AS BIGINT) AS balance FROM p GROUP BY 2, 3 UNION ALL SELECT 'region', r_name, NULL, CAST(sum(b) AS BIGINT) FROM p GROUP BY r_name")
def _(spark, sf_dir):
    return A.rollup_once(_placed(spark, sf_dir), {"nation": ["r_name", "n_name"], "region": ["r_name"]}, exclude=["c_nationkey"])


@query("agg_hierarchy_count", "SELECT c_mktsegment, count(*) AS record_count FROM customer GROUP BY 1")
def _(spark, sf_dir):
    return A.level(table(spark, sf_dir, "customer").select("c_mktsegment", "c_name"), ["c_mktsegment"])


@query("agg_hierarchy_over_mart", "SELECT r_name, CAST(sum(CAST(round(c_acctbal) AS BIGINT)) AS BIGINT) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, sf_dir):
    mart = A.level(_placed(spark, sf_dir), ["r_name", "n_name"], exclude=["c_nationkey"])
    return A.level(mart, ["r_name"])


@query(
    "agg_profile_distinct",
    "SELECT c AS \"column\", d AS exact, n AS nulls, TRUE AS within_bound FROM (SELECT 'l_returnflag' AS c, count(DISTINCT l_returnflag) AS d, count(*) FILTER (l_returnflag IS NULL) AS n FROM lineitem UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey), 0 FROM lineitem UNION ALL SELECT 'odd', count(DISTINCT l_suppkey) FILTER (l_linenumber > 1), count(*) FILTER (l_linenumber = 1) FROM lineitem)",
)
def _(spark, sf_dir):
    """Approximate counts beside exact ones: within five times the estimator's standard error, 1.6 %, or one value."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", F.when(F.col("l_linenumber") > 1, F.col("l_suppkey")).alias("odd"))
    got = A.profile_distinct(lines, lines.columns)
    exact = A.unpivoted(lines, lines.columns).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*")).groupBy("column").agg(F.count("*").alias("exact"))
    return got.join(exact, "column").select("column", "exact", "nulls", (F.abs(F.col("distinct_approx") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 5 * 0.016)).alias("within_bound"))


@query(
    "agg_profile_sketches",
    """WITH y AS (SELECT year(o_orderdate) AS year, o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS note FROM orders),
g AS (SELECT 'all' AS years, * EXCLUDE (year) FROM y UNION ALL SELECT CASE WHEN year < 1995 THEN 'early' ELSE 'late' END, * EXCLUDE (year) FROM y)
SELECT years, 'o_custkey' AS "column", count(DISTINCT o_custkey) AS exact, count(*) FILTER (o_custkey IS NULL) AS nulls, TRUE AS within_bound FROM g GROUP BY 1
UNION ALL SELECT years, 'note', count(DISTINCT note), count(*) FILTER (note IS NULL), TRUE FROM g GROUP BY 1""",
)
def _(spark, sf_dir):
    """Sketches of each year, stored once; unions of years are profiled from them, beside exact counts."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("note"))
    some = F.when(F.col("year") < 1995, "early").otherwise("late")
    stored = written(A.sketches(o, ["year"], ["o_custkey", "note"]), "sketches")
    both = A.sketched_profile(stored.withColumn("years", some), ["years"]).unionByName(A.sketched_profile(stored.withColumn("years", F.lit("all")), ["years"]))
    long = A.unpivoted(o.withColumn("years", F.explode(F.array(F.lit("all"), some))), ["o_custkey", "note"], "years")
    exact = long.filter("value IS NOT NULL").groupBy("years", "column", "value").agg(F.count("*")).groupBy("years", "column").agg(F.count("*").alias("exact"))
    return both.join(exact, ["years", "column"]).select("years", "column", "exact", "nulls", (F.abs(F.col("distinct_approx") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 5 * 0.016)).alias("within_bound"))


_TOP = """WITH u AS (SELECT 'o_orderstatus' AS c, o_orderstatus AS value FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
g AS (SELECT c, value, count(*) AS n FROM u GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, value) AS rank, sum(n) OVER (PARTITION BY c) AS whole, count(*) OVER (PARTITION BY c) AS k FROM g)
SELECT c AS "column", value, n AS count, round(n * 100.0 / whole, 2) AS pct, CAST(rank AS INTEGER) AS rank, k > 4 AS truncated FROM r WHERE rank <= 4"""


@query("agg_top_values", _TOP)
def _(spark, sf_dir):
    return A.top_values(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], 4)


@query("agg_missingness", "SELECT 'half' AS \"column\", round(count(*) FILTER (o_orderkey % 2 = 0) * 100.0 / count(*), 4) AS pct FROM orders UNION ALL SELECT 'o_orderkey', 0.0")
def _(spark, sf_dir):
    return A.missingness(table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise("x").alias("half")))


@query("agg_preview", "SELECT count(*) AS row_count, count(*) > 20 AS truncated, 3 AS columns FROM region")
def _(spark, sf_dir):
    regions = table(spark, sf_dir, "region")
    got = A.preview(regions.withColumn("extra", F.lit(1)).select("r_regionkey", "r_name", "extra"))
    return got["rows"].agg(F.lit(got["row_count"]).cast("long").alias("row_count"), F.lit(got["truncated"]).alias("truncated"), F.lit(len(got["schema"])).alias("columns"))


@query("agg_row_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query("agg_schema", "SELECT 'r_regionkey' AS name, 'int' AS type FROM (SELECT count(*) FROM region) UNION ALL SELECT 'r_name', 'string'")
def _(spark, sf_dir):
    from marblework.operators.joins import column_rows

    return column_rows(table(spark, sf_dir, "region"))


@query("agg_dup_keys", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf_dir):
    return A.duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("agg_dup_rows", "SELECT count(*) - count(DISTINCT (l_partkey % 100, l_returnflag)) AS duplicate_rows FROM lineitem")
def _(spark, sf_dir):
    return A.duplicate_rows(table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("k"), "l_returnflag"))


@query("agg_mean_stdev_outliers", "WITH s AS (SELECT avg(v) AS m, stddev_samp(v) AS d FROM (SELECT CASE WHEN event_id % 500 = 0 THEN value * 1000 ELSE value END AS v FROM events)) SELECT 'v' AS \"column\", count(*) AS n, count(*) FILTER (abs(v - m) > 4 * d) AS outliers FROM (SELECT CASE WHEN event_id % 500 = 0 THEN value * 1000 ELSE value END AS v FROM events), s")
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 500 == 0, F.col("value") * 1000).otherwise(F.col("value")).alias("v"))
    return A.outliers(e, ["v"])


@query("agg_status_summary", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf_dir):
    return A.status_summary(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("ord_cap", "SELECT o_orderkey, total_count, total_count > 500 AS truncated FROM orders, (SELECT count(*) AS total_count FROM orders) ORDER BY o_orderkey LIMIT 500")
def _(spark, sf_dir):
    got = A.answer(table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey"), 500)
    rows = spark.createDataFrame(got["rows"], "o_orderkey long")
    return rows.select("o_orderkey", F.lit(got["total_count"]).cast("long").alias("total_count"), F.lit(got["truncated"]).alias("truncated"))


@query("ord_list_limit", "SELECT n_name FROM nation ORDER BY n_name LIMIT 15")
def _(spark, sf_dir):
    return A.capped(table(spark, sf_dir, "nation").select("n_name").orderBy("n_name"), 15)[0]
