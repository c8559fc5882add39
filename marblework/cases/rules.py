"""Validation rules over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import joins as J
from marblework.operators import rollup as A
from marblework.operators import rules as R
from marblework.registry import query
from marblework.session import table


def _results(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_note", F.when(F.col("o_orderkey") % 3 > 0, F.lit("x"))).withColumn("importo", F.col("o_totalprice").cast("string"))
    rules = R.Rules(required=["o_orderkey", "absent"], min_rows=10, not_null=["o_custkey", "o_note", "gone"], primary_key=["o_custkey"], ranges={"o_totalprice": (1000.0, 200000.0)}, max_null_pct={"o_note": 10.0})
    return R.evaluate(orders, rules)


_FACTS = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 > 0 THEN 'x' END AS o_note FROM orders),
f AS (SELECT 'required_columns' AS rule, 'o_orderkey' AS c, CAST(0 AS BIGINT) AS bad_rows, 'error' AS severity
UNION ALL SELECT 'required_columns', 'absent', 1, 'error'
UNION ALL SELECT 'min_rows', '', greatest(0, 10 - count(*)), 'error' FROM o
UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (o_custkey IS NULL), 'error' FROM o
UNION ALL SELECT 'not_null', 'o_note', count(*) FILTER (o_note IS NULL), 'error' FROM o
UNION ALL SELECT 'not_null', 'gone', 1, 'warning'
UNION ALL SELECT 'range', 'o_totalprice', count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 200000), 'error' FROM o
UNION ALL SELECT 'max_null_pct', 'o_note', CASE WHEN count(*) FILTER (o_note IS NULL) * 100.0 > 10 * count(*) THEN count(*) FILTER (o_note IS NULL) ELSE 0 END, 'error' FROM o
UNION ALL SELECT 'type_by_name', 'importo', 1, 'warning'
UNION ALL SELECT 'primary_key', 'o_custkey', count(*), 'error' FROM (SELECT o_custkey FROM o GROUP BY 1 HAVING count(*) > 1)) """


@query("val_rules", _FACTS + 'SELECT rule, c AS "column", bad_rows, severity FROM f')
def _(spark, sf_dir):
    return _results(spark, sf_dir).select("rule", "column", "bad_rows", "severity")


@query("val_report", _FACTS + ", n AS (SELECT count(*) FILTER (bad_rows > 0 AND severity = 'error') AS errors, count(*) FILTER (bad_rows > 0 AND severity = 'warning') AS warnings FROM f), s AS (SELECT *, CAST(greatest(0, 100 - 20 * errors - 5 * warnings) AS INTEGER) AS score FROM n) SELECT errors = 0 AS passed, errors, warnings, score, CASE WHEN score >= 80 THEN 'good' WHEN score >= 50 THEN 'acceptable' ELSE 'poor' END AS grade FROM s")
def _(spark, sf_dir):
    return R.report(_results(spark, sf_dir)).drop("messages")


for _name, _rule in (("val_required_columns", "required_columns"), ("val_min_rows", "min_rows"), ("val_not_null", "not_null"), ("val_range", "range"), ("val_max_null_pct", "max_null_pct"), ("val_primary_key", "primary_key"), ("val_type_by_name", "type_by_name")):
    query(_name, _FACTS + f"SELECT c AS \"column\", bad_rows, severity FROM f WHERE rule = '{_rule}'")(lambda spark, sf_dir, r=_rule: _results(spark, sf_dir).filter(F.col("rule") == r).select("column", "bad_rows", "severity"))


@query("val_non_empty", "SELECT 'orders' AS name, count(*) = 0 AS failed FROM orders UNION ALL SELECT 'none', count(*) FILTER (o_totalprice < 0) = 0 FROM orders")
def _(spark, sf_dir):
    """A table with rows and one that a filter leaves without any."""
    orders = table(spark, sf_dir, "orders")
    one = lambda name, df: R.evaluate(df, R.Rules(min_rows=1)).filter("rule = 'min_rows'").select(F.lit(name).alias("name"), (F.col("bad_rows") > 0).alias("failed"))
    return one("orders", orders).unionByName(one("none", orders.filter("o_totalprice < 0")))


@query("val_score", "SELECT o_orderkey, CAST(greatest(0, 100 - 20 * (o_orderkey % 5) - 5 * (o_custkey % 4)) AS INTEGER) AS score, CASE WHEN greatest(0, 100 - 20 * (o_orderkey % 5) - 5 * (o_custkey % 4)) >= 80 THEN 'good' WHEN greatest(0, 100 - 20 * (o_orderkey % 5) - 5 * (o_custkey % 4)) >= 50 THEN 'acceptable' ELSE 'poor' END AS grade FROM orders")
def _(spark, sf_dir):
    score = R.quality_score(F.col("o_orderkey") % 5, F.col("o_custkey") % 4)
    return table(spark, sf_dir, "orders").select("o_orderkey", score.alias("score"), R.grade(score).alias("grade"))


_WIDE = [f"Misura{i}" for i in range(40)]


@query(
    "val_not_null_inferred",
    "SELECT name FROM (VALUES "
    + ", ".join(f"('misura{i}', {i})" for i in range(40))
    + ") t(name, i) WHERE (SELECT count(*) FILTER (i % 3 = 0 AND o_custkey % (i + 2) = 0) FROM orders) = 0 UNION ALL SELECT 'o_custkey' FROM orders HAVING count(*) FILTER (o_custkey IS NULL) = 0 AND count(*) > 0",
)
def _(spark, sf_dir):
    """Forty columns, a third of them with gaps where their divisor meets a customer, and a key."""
    o = table(spark, sf_dir, "orders")
    gap = lambda i: F.when((F.lit(i) % 3 != 0) | (F.col("o_custkey") % (i + 2) != 0), F.col("o_totalprice").cast("string")).otherwise(" ")
    raw = o.select("o_custkey", *[gap(i).alias(n) for i, n in enumerate(_WIDE)])
    clean = raw.toDF("o_custkey", *map(str.lower, _WIDE))
    names = R.inferred_not_null(A.missing_cells(raw), clean.columns)
    return J.column_rows(clean).filter(F.col("name").isin(names)).select("name")


@query("val_transition_rows", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round((count(*) - count(*) FILTER (o_orderstatus <> 'F')) * 100.0 / count(*), 2) AS drop_pct, round((count(*) - count(*) FILTER (o_orderstatus <> 'F')) * 100.0 / count(*), 2) > 40 AS bad FROM orders GROUP BY 1")
def _(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("a"), F.count_if(F.col("o_orderstatus") != "F").alias("b"))
    return per.select("year", R.transition(F.col("a"), F.col("b"), 40.0).alias("t")).select("year", "t.drop_pct", "t.bad")


@query(
    "val_transition_columns",
    "WITH c AS (SELECT DISTINCT c_mktsegment AS c FROM customer), d AS (SELECT DISTINCT c_mktsegment AS c FROM customer WHERE c_nationkey = 3), n AS (SELECT (SELECT count(*) FROM c WHERE c NOT IN (SELECT c FROM d)) AS removed, CAST(1 AS BIGINT) AS added) SELECT removed, added, removed > added AS bad FROM n",
)
def _(spark, sf_dir):
    """Columns named after the segments of all customers, then after those of one nation and another."""
    c = table(spark, sf_dir, "customer")
    named = lambda df: df.select(F.col("c_mktsegment").alias("name"), F.lit("int").alias("type")).distinct()
    more = spark.createDataFrame([("anno", "int")], "name string, type string")
    return R.lost_columns(J.diff_layers(named(c), named(c.filter("c_nationkey = 3")).unionByName(more)))


@query("val_promotion", "SELECT CAST(year(o_orderdate) AS VARCHAR) AS dataset, TRUE AS has_raw, round(count(*) FILTER (o_totalprice > 50000) * 100.0 / count(*), 2) AS row_pct, CAST(66.67 AS DOUBLE) AS column_pct FROM orders GROUP BY 1 HAVING count(*) FILTER (o_totalprice > 50000) > 0")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("dataset", F.year("o_orderdate").cast("string"))
    raw = o.groupBy("dataset").agg(F.count("*").alias("rows"), F.lit(6).alias("columns"))
    return R.promotion(raw, o.filter("o_totalprice > 50000").groupBy("dataset").agg(F.count("*").alias("rows"), F.lit(4).alias("columns")))


_SEEN = "SELECT DISTINCT 'mart_' || c_mktsegment AS t FROM customer WHERE c_nationkey = 3"


@query(
    "val_required_tables",
    f"SELECT t AS \"table\", 'missing' AS problem FROM (SELECT DISTINCT 'mart_' || c_mktsegment AS t FROM customer UNION SELECT 'mart_X') WHERE t NOT IN ({_SEEN}) UNION ALL SELECT 'mart_Y', 'orphan rule' FROM customer HAVING count(*) > 0",
)
def _(spark, sf_dir):
    """All segments' tables and one more are declared; those of one nation are there."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("mart_"), "c_mktsegment").alias("table"), "c_nationkey")
    declared = sorted({r["table"] for r in c.select("table").distinct().collect()} | {"mart_X"})  # one row per segment
    return R.required_tables(declared, [declared[0], "mart_Y"], c.filter("c_nationkey = 3").select("table").distinct())


@query("val_rule_suggest", "SELECT greatest(1, CAST(floor(count(*) / 2) AS BIGINT)) AS min_rows, ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate'] AS required FROM orders")
def _(spark, sf_dir):
    return R.suggested(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


@query("val_naming", "SELECT DISTINCT p_brand AS name FROM part WHERE NOT regexp_full_match(p_brand, '[a-z][a-z0-9_]*')")
def _(spark, sf_dir):
    return R.bad_names(table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct())


@query("val_rule_coverage", "SELECT round(count(DISTINCT c_nationkey) FILTER (c_acctbal > 9000) * 100.0 / count(DISTINCT c_nationkey), 2) AS pct, round(count(DISTINCT c_nationkey) FILTER (c_acctbal > 9000) * 100.0 / count(DISTINCT c_nationkey), 2) >= 80 AS ok FROM customer")
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("name"), "c_acctbal")
    return R.rule_coverage(c, c.filter("c_acctbal > 9000"))


@query("val_coherence", "SELECT c_custkey FROM customer WHERE c_nationkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def _(spark, sf_dir):
    runs = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 2 == 0, "SUCCESS").otherwise("FAILED").alias("status"))
    return R.incoherent(runs, table(spark, sf_dir, "orders").filter("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@query("val_sample_relax", "SELECT 'min_rows' AS rule, CAST(0 AS BIGINT) AS bad_rows, (SELECT greatest(0, 1000000 - count(*)) FROM nation) AS unrelaxed")
def _(spark, sf_dir):
    nations, rules = table(spark, sf_dir, "nation"), R.Rules(min_rows=10**6, types_by_name=False)
    strict = R.evaluate(nations, rules).select("rule", F.col("bad_rows").alias("unrelaxed"))
    return R.evaluate(nations, rules.relaxed()).select("rule", "bad_rows").join(strict, "rule")


@query("val_gate", "SELECT CAST(count(*) AS BIGINT) AS n FROM nation")
def _(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    if not R.passes(R.report(R.evaluate(nations, R.Rules(primary_key=["n_nationkey"], not_null=["n_name"])))):
        raise ValueError("the clean layer failed its rules")
    return nations.agg(F.count("*").alias("n"))
