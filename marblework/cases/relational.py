"""Projections, filters, joins, sorts and set operations as user SQL states them."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.functions import text as X
from marblework.operators import joins as J
from marblework.registry import query
from marblework.session import table


def _sql(name: str, text: str, *tables: str, spark_text: str | None = None, **params):
    """The same SQL for both engines; tables are DataFrame parameters."""

    def run(spark, sf_dir):
        X.register_sql(spark)
        frames = {t: table(spark, sf_dir, t) for t in tables}
        said = spark_text or text
        for t in tables:
            said = said.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
        return spark.sql(said, **frames)

    query(name, text)(run)


_sql("rel_project", "SELECT o_orderkey AS order_id, TRY_CAST(o_orderstatus AS INTEGER) AS status_code, NULLIF(TRIM(o_orderpriority), '') AS priority, CAST(o_totalprice AS DOUBLE) AS total FROM orders", "orders", spark_text="SELECT o_orderkey AS order_id, cast_int(o_orderstatus) AS status_code, normalize_string(o_orderpriority) AS priority, cast_double(o_totalprice) AS total FROM orders")
_sql("rel_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus = 'O' AND l_returnflag <> '' AND l_quantity > 30", "lineitem")
_sql("rel_coalesce", "SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'O'), NULLIF(o_orderpriority, '1-URGENT'), 'none') AS label FROM orders", "orders")
_sql("rel_case_ratio", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 10 THEN l_extendedprice / l_quantity ELSE NULL END AS unit_price, l_extendedprice - l_tax AS net FROM lineitem", "lineitem")
_sql("rel_cte", "WITH a AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 1000), b AS (SELECT o_custkey, count(*) AS n FROM a GROUP BY o_custkey) SELECT o_custkey, n FROM b WHERE n > 2", "orders")
_sql("agg_group", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY l_returnflag, l_linestatus", "lineitem")
_sql("agg_group_ordinal", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2", "orders")
_sql("agg_round", "SELECT COALESCE(c_mktsegment, 'none') AS segment, round(sum(c_acctbal), 1) AS total, round(avg(c_acctbal), 2) AS mean FROM customer GROUP BY 1 ORDER BY total DESC", "customer")
_sql("ord_sort", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey", "supplier")
_sql("ord_topk", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10", "part")


@query("rel_year_literal", "SELECT n_nationkey, n_name, CAST(2023 AS INTEGER) AS anno FROM nation")
def _(spark, sf_dir):
    return spark.sql("SELECT n_nationkey, n_name, CAST(:year AS INT) AS anno FROM {nation}", args={"year": 2023}, nation=table(spark, sf_dir, "nation"))


@query("rel_year_guard", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anno FROM orders WHERE o_orderkey % 4 <> 0")
def _(spark, sf_dir):
    said = F.when(F.col("o_orderkey") % 4 == 0, "totale").otherwise(F.year("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.cast_int(said).alias("anno")).filter("anno IS NOT NULL")


@query("rel_sample", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 100)")
def _(spark, sf_dir):
    from marblework.plans.layers import run_clean

    return run_clean(table(spark, sf_dir, "orders"), "SELECT * FROM {raw_input}", sample_rows=100).agg(F.count("*").alias("n"))


@query("rel_typed_projection", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, NULLIF(TRIM(o_orderstatus), '') AS o_orderstatus, o_totalprice, o_orderdate, NULLIF(TRIM(o_orderpriority), '') AS o_orderpriority, CAST(2024 AS INTEGER) AS anno FROM orders")
def _(spark, sf_dir):
    from marblework.plans.layers import typed_projection

    return typed_projection(table(spark, sf_dir, "orders"), 2024)


@query("join_support", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf_dir):
    names = J.register_support({"places": {"mart": table(spark, sf_dir, "nation")}})
    return spark.sql("SELECT c_custkey, n_name FROM {c} LEFT JOIN {places_mart} ON c_nationkey = n_nationkey", c=table(spark, sf_dir, "customer"), **names)


@query("join_hub", "SELECT c_custkey, n_name FROM customer JOIN nation ON lpad(CAST(c_nationkey AS VARCHAR), 6, '0') = lpad(CAST(n_nationkey AS VARCHAR), 6, '0')")
def _(spark, sf_dir):
    hub = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("code"), "n_name")
    return J.join_hub(table(spark, sf_dir, "customer"), "c_nationkey", hub, "code", ["direct", "lpad6", "right6"]).select("c_custkey", "n_name")


@query("join_hub_choice", "SELECT 'direct' AS normalizer, CAST(0 AS BIGINT) AS matched UNION ALL SELECT 'lpad6', count(DISTINCT c_nationkey) FROM customer")
def _(spark, sf_dir):
    hub = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("code"))
    return J.best_normalizer(table(spark, sf_dir, "customer"), "c_nationkey", hub, "code", ["direct", "lpad6"]).select("normalizer", "matched")


@query("join_bridge", "SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return J.join_bridge(t("supplier"), "s_nationkey", t("nation"), "n_nationkey", "n_regionkey", t("region"), "r_regionkey").select("s_suppkey", "r_name")


@query("join_cross_dataset", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def _(spark, sf_dir):
    from marblework.plans.adhoc import guarded

    frames = {"ordini": table(spark, sf_dir, "orders"), "clienti": table(spark, sf_dir, "customer")}
    return guarded(spark, "SELECT o_orderkey, c_name FROM ordini JOIN clienti ON o_custkey = c_custkey WHERE c_acctbal > 0", frames)


@query("join_unmatched", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def _(spark, sf_dir):
    return J.unmatched(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").filter("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


def _per_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    return {y: orders.filter(year == y).select("o_orderkey", "o_totalprice", F.lit(y).alias("anno")) for y in (1995, 1996)}


@query("set_union_years", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS anno FROM orders WHERE year(o_orderdate) IN (1995, 1996)")
def _(spark, sf_dir):
    return J.union_years(_per_year(spark, sf_dir), [1995, 1996])


@query("set_multi_year_mart", "SELECT CAST(year(o_orderdate) AS INTEGER) AS anno, count(*) AS n, '1995,1996' AS years FROM orders WHERE year(o_orderdate) IN (1995, 1996) GROUP BY 1")
def _(spark, sf_dir):
    from marblework.plans.layers import run_mart_multi_year

    return run_mart_multi_year(_per_year(spark, sf_dir), [1995, 1996], {"m": "SELECT anno, count(*) AS n, :years_csv AS years FROM {clean} GROUP BY anno"})["m"]


@query("set_union_files", "SELECT o_orderkey, 'a' AS origin, NULL AS part FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, 'b' FROM orders WHERE o_orderkey % 2 = 1")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return J.union_by_name([o.filter("o_orderkey % 2 = 0").withColumn("origin", F.lit("a")), o.filter("o_orderkey % 2 = 1").withColumn("part", F.lit("b"))])


@query("set_concat_frames", "SELECT CAST(c_custkey AS VARCHAR) AS a, CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END AS b FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), '' FROM supplier")
def _(spark, sf_dir):
    """Padded files one after the other, each with its own short rows."""
    from marblework.cases.sources import landed
    from marblework.sources.delimited import read_padded

    key = F.col("c_custkey")
    first = landed(spark, table(spark, sf_dir, "customer").select(F.concat(key.cast("string"), F.when(key % 2 == 0, ";x").otherwise("")).alias("value")), kind="text")
    second = landed(spark, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("value")), kind="text")
    return J.union_by_name([read_padded(spark, [p], ["a", "b"], {"sep": ";", "header": False}) for p in (first, second)])


@query("set_merge_prefer", "SELECT c_nationkey AS k, 'local' AS origin FROM customer WHERE c_nationkey < 10 GROUP BY 1 UNION ALL SELECT s_nationkey, 'shared' FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey < 10) GROUP BY 1")
def _(spark, sf_dir):
    a = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_nationkey").alias("k")).distinct().withColumn("origin", F.lit("local"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).distinct().withColumn("origin", F.lit("shared"))
    return J.merge_prefer(a, b, ["k"])


@query(
    "set_diff_columns",
    """WITH c AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS c FROM orders WHERE NOT (year(o_orderdate) % 2 = 0 AND o_orderpriority = '1-URGENT')),
p AS (SELECT y, list(c) AS now FROM c GROUP BY y), b AS (SELECT lag(y) OVER (ORDER BY y) AS from_year, y AS to_year, lag(now) OVER (ORDER BY y) AS before, now FROM p)
SELECT from_year, to_year, list_sort(list_filter(now, lambda x: NOT list_contains(before, x))) AS added, list_sort(list_filter(before, lambda x: NOT list_contains(now, x))) AS removed FROM b WHERE from_year IS NOT NULL""",
)
def _(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("column")).filter("NOT (year % 2 = 0 AND column = '1-URGENT')").distinct()
    return J.diff_columns(seen)


@query(
    "set_diff_layers",
    """WITH n AS (SELECT count(*) AS source_rows, count(*) FILTER (o_totalprice > 100000) AS target_rows FROM orders)
SELECT key, change, source_rows, target_rows, target_rows - source_rows AS row_delta FROM n, (VALUES ('O_ORDERKEY', 'same'), ('O_CUSTKEY', 'removed'), ('O_TOTALPRICE', 'retyped'), ('ANNO', 'added')) t(key, change)""",
)
def _(spark, sf_dir):
    """Two layers as they are written: some columns go, come or change type, and rows are filtered."""
    from marblework.sources.shared import written

    orders = table(spark, sf_dir, "orders")
    source = written(orders.select("o_orderkey", "o_custkey", "o_totalprice"), "layer")
    target = written(orders.filter("o_totalprice > 100000").select("o_orderkey", F.col("o_totalprice").cast("string").alias("o-totalprice"), F.year("o_orderdate").alias("anno")), "layer")
    return J.diff_tables(source, target).select("key", "change", "source_rows", "target_rows", "row_delta")
