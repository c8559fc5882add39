"""Ad-hoc SQL over layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import rollup as A
from marblework.plans import adhoc as Q
from marblework.plans.layers import run_sql
from marblework.registry import query
from marblework.session import table


def _layers(spark, sf_dir):
    """Orders as text (raw), typed (clean) and summed (mart), by year."""
    o = table(spark, sf_dir, "orders")
    of = lambda y: o.filter(F.year("o_orderdate") == y)
    raw = lambda y: of(y).select(F.col("o_orderkey").alias("n"), F.col("o_totalprice").cast("string").alias("prezzo"), F.col("o_orderstatus").alias("stato"))
    mart = lambda y: of(y).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    years = (1995, 1996)
    return {"raw": {(y, "orders"): raw(y) for y in years}, "clean": {(y, "orders"): of(y) for y in years}, "mart": {(y, "by_status"): mart(y) for y in years}}


@query(
    "sql_layer",
    """SELECT 'clean 1995' AS asked, o_orderstatus AS a, CAST(count(*) AS VARCHAR) AS b FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 2
UNION ALL SELECT 'mart last', o_orderstatus, CAST(count(*) AS VARCHAR) FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 2
UNION ALL SELECT 'raw schema', a, b FROM (VALUES ('n', 'bigint'), ('prezzo', 'string'), ('stato', 'string')) t(a, b)
UNION ALL SELECT 'raw profile', a, b FROM (VALUES ('prezzo', 'float'), ('stato', 'str')) t(a, b) WHERE (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1996) > 0""",
)
def _(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    out = Q.ask(spark, layers, "clean", "sql", 1995, sql="SELECT 'clean 1995' AS asked, o_orderstatus AS a, CAST(count(*) AS STRING) AS b FROM data GROUP BY 2")
    more = [
        Q.ask(spark, layers, "mart", "preview").selectExpr("'mart last' AS asked", "o_orderstatus AS a", "CAST(n AS STRING) AS b"),
        Q.ask(spark, layers, "raw", "schema").selectExpr("'raw schema' AS asked", "name AS a", "type AS b"),
        Q.ask(spark, layers, "raw", "profile").selectExpr("'raw profile' AS asked", "column AS a", "type AS b"),
    ]
    for df in more:
        out = out.unionByName(df)
    return out


#: Statements that a guard must not let through.
REFUSED = (
    "DROP TABLE x",
    "INSERT INTO ordini SELECT * FROM clienti",
    "SELECT * FROM read_parquet('x')",
    "SELECT * FROM altro",
    "SELECT 1; SELECT 2",
    "SELECT * FROM parquet.`/x`",
    "SELECT * FROM ordini, altro",
    "SELECT o_orderkey FROM ordini UNION ALL TABLE altro",
    "SELECT * FROM ordini WHERE o_custkey IN (SELECT x FROM altro)",
    "SELECT reflect('java.lang.System', 'getenv', 'PATH') FROM ordini",
    "SELECT `reflect`('java.lang.System', 'getProperty', 'user.home') FROM ordini",
    'SELECT "reflect"(\'java.lang.System\', \'getProperty\', \'user.home\') FROM ordini',
    "SELECT `java_method`('java.lang.System', 'getProperty', 'user.home') FROM ordini",
    "SELECT '\\'', reflect('java.lang.System', 'getenv', 'PATH'), '\\'' FROM ordini",
    "SELECT system.builtin.reflect('java.lang.System', 'getenv', 'PATH') FROM ordini",
    "SELECT count(*) OVER w FROM ordini WINDOW w AS (PARTITION BY try_reflect('java.lang.System', 'getenv', 'PATH'))",
    "SELECT transform(array(1), x -> reflect('java.lang.System', 'getenv', 'PATH')) FROM ordini",
    "SELECT * FROM ordini ORDER BY reflect('java.lang.System', 'getenv', 'PATH')",
    "SELECT * FROM ordini LATERAL VIEW explode(array(reflect('java.lang.System', 'getenv', 'PATH'))) t AS x",
    "SELECT * FROM VALUES (reflect('java.lang.System', 'getenv', 'PATH')) t(x)",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getenv', 'PATH') FROM ordini",
    "SELECT * FROM IDENTIFIER('al' || 'tro')",
    "SELECT input_file_name() FROM ordini",
    "SELECT * FROM range(5)",
)


@query("sql_guarded", "WITH big AS (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) SELECT c_name, count(*) AS n FROM big JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def _(spark, sf_dir):
    frames = {"ordini": table(spark, sf_dir, "orders"), "clienti": table(spark, sf_dir, "customer")}
    for bad in REFUSED[:14]:  # the tests try all
        try:
            Q.guarded(spark, bad, frames)
        except ValueError:
            continue
        raise AssertionError(f"passed: {bad}")
    return Q.guarded(spark, "WITH big AS (SELECT o_custkey FROM ordini WHERE o_totalprice > 100000) SELECT c_name, count(*) AS n FROM big, clienti WHERE c_custkey = o_custkey GROUP BY 1", frames)


@query("sql_params", "SELECT o_orderkey, 'ordini' AS dataset FROM orders WHERE year(o_orderdate) = 1996")
def _(spark, sf_dir):
    return run_sql(spark, "SELECT o_orderkey, :dataset AS dataset FROM {clean} WHERE year(o_orderdate) = :year", {"clean": table(spark, sf_dir, "orders")}, {"year": 1996, "dataset": "ordini"})


@query("sql_dry_run", "SELECT o_orderstatus, count(*) AS n, 2 AS n_columns, TRUE AS good, TRUE AS planned, FALSE AS bad FROM orders GROUP BY 1")
def _(spark, sf_dir):
    """A statement is bound and not run; what it would be is then asked of the table."""
    orders = table(spark, sf_dir, "orders")
    sql = "SELECT o_orderstatus, count(*) AS n FROM data GROUP BY 1"
    good, bad = Q.dry_run(spark, {"data": orders}, sql), Q.dry_run(spark, {"data": orders}, "SELECT nope FROM data")
    planned = bool(good["plan"]) and good["plan"].startswith("Aggregate")
    return Q.guarded(spark, sql, {"data": orders}).select("*", F.lit(len(good["schema"])).alias("n_columns"), F.lit(good["ok"]).alias("good"), F.lit(planned).alias("planned"), F.lit(bad["ok"]).alias("bad"))


@query("sql_preview", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def _(spark, sf_dir):
    return A.preview(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey"), 5)["rows"]
