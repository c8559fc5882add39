"""Catalogue, graph and run history over rows derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import catalog as C
from marblework.registry import query
from marblework.session import table


def _schemas(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.lower("o_orderpriority").alias("slug"), F.year("o_orderdate").alias("year")).agg(F.array_sort(F.collect_set("o_orderstatus")).alias("columns"))


@query("cat_clean", "WITH s AS (SELECT lower(o_orderpriority) AS slug, year(o_orderdate) AS y, list_sort(list_distinct(list(o_orderstatus))) AS columns FROM orders GROUP BY 1, 2), d AS (SELECT slug, arg_max(columns, y) AS columns, list(CAST(y AS INTEGER) ORDER BY y) AS years FROM s GROUP BY 1) SELECT 'extra' AS slug, 'Solo' AS title, 'x' AS description, NULL AS columns, NULL AS years FROM (SELECT count(*) FROM orders) UNION ALL SELECT slug, CASE WHEN slug = '1-urgent' THEN 'Urgenti' ELSE slug END AS title, CASE WHEN slug = '1-urgent' THEN 'x' ELSE '' END, columns, years FROM d")
def _(spark, sf_dir):
    schemas = _schemas(spark, sf_dir)
    editorial = spark.createDataFrame([("1-urgent", "Urgenti", "x"), ("extra", "Solo", "x")], "slug string, title string, description string")
    got = C.clean_entries(schemas, editorial)
    plain = F.when(F.col("slug").isin("1-urgent", "extra"), F.col("title")).otherwise(F.col("slug"))
    return got.withColumn("title", plain)


@query("cat_mart", "SELECT c_mktsegment AS slug, t AS \"table\", CASE WHEN c_mktsegment = 'BUILDING' THEN 'data/mart/' || c_mktsegment || '/' || t || '.parquet' ELSE 'data/mart/' || c_mktsegment || '/' || y || '/' || t || '.parquet' END AS location FROM (SELECT c_mktsegment, max(c_nationkey) AS y FROM customer GROUP BY 1), (SELECT unnest(['a', 'b']) AS t)")
def _(spark, sf_dir):
    d = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("slug")).agg(F.collect_set("c_nationkey").alias("years"))
    return C.mart_entries(d.select("slug", "years", (F.col("slug") == "BUILDING").alias("multi_year"), F.array(F.lit("a"), F.lit("b")).alias("tables")))


def _runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS")
    return o.select(F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("started_at"), status.alias("status"), (F.col("o_orderkey") % 2).alias("warnings"))


_RUNS = "r AS (SELECT o_custkey AS slug, o_orderkey AS run_id, o_orderdate AS started_at, CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status, o_orderkey % 2 AS warnings FROM orders), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY started_at DESC, run_id DESC) AS k FROM r) WHERE k = 1)"


@query("cat_signals", f"WITH {_RUNS} SELECT slug, CASE WHEN status <> 'SUCCESS' THEN 'error' WHEN warnings > 0 THEN 'warn' ELSE 'ok' END AS status, CASE WHEN status <> 'SUCCESS' THEN 'rerun' WHEN warnings > 0 THEN 'review' ELSE 'none' END AS action FROM l")
def _(spark, sf_dir):
    return C.signals(_runs(spark, sf_dir))


@query("op_latest_run", f"WITH {_RUNS} SELECT slug, run_id, status FROM l")
def _(spark, sf_dir):
    return C.latest_runs(_runs(spark, sf_dir), ["slug"]).select("slug", "run_id", "status")


@query("op_runs", f"WITH {_RUNS} SELECT slug, run_id FROM r WHERE started_at >= TIMESTAMP '1995-01-01' AND started_at <= TIMESTAMP '1996-12-31' AND status = 'FAILED' ORDER BY started_at DESC, run_id LIMIT 50")
def _(spark, sf_dir):
    return C.runs(_runs(spark, sf_dir), "1995-01-01", "1996-12-31", "FAILED", 50).select("slug", "run_id")


@query("op_durations", "SELECT event_id, CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 100 AS BIGINT) END AS s FROM events")
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    end = F.timestamp_add("SECOND", F.when(F.col("event_id") % 5 > 0, F.col("event_id") % 100), F.col("ts"))
    return e.select("event_id", C.seconds_between(F.col("ts"), end).alias("s"))


@query("op_resume", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'raw' WHEN c_custkey % 5 = 0 THEN 'clean' ELSE 'mart' END AS layer FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0")
def _(spark, sf_dir):
    k = F.col("c_custkey")
    each = table(spark, sf_dir, "customer").select(k, F.explode(F.array(*map(F.lit, C.LAYERS))).alias("layer"))
    bad = F.when(F.col("layer") == "raw", k % 3 == 0).when(F.col("layer") == "clean", k % 5 == 0).otherwise(k % 7 == 0)
    return C.resume_layer(each.select("c_custkey", "layer", F.when(bad & (k % 2 == 0), "FAILED").otherwise("SUCCESS").alias("status"), ~(bad & (k % 2 == 1)).alias("has_artifact")).toDF("c_custkey", "layer", "status", "has_artifact"), ["c_custkey"])


@query("op_ensure", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def _(spark, sf_dir):
    return C.to_ensure(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").filter("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("cat_runs_backfill", "SELECT c_custkey AS slug, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'old' || c_custkey END AS run FROM customer")
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    now = c.select(F.col("c_custkey").alias("slug"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("run"))
    return C.backfill(now, c.select(F.col("c_custkey").alias("slug"), F.concat(F.lit("old"), F.col("c_custkey").cast("string")).alias("run")), "slug", ["run"])


@query(
    "cat_find",
    """WITH e AS (SELECT p_name AS slug, coalesce(list_sort(list_distinct(list(p_type) FILTER (contains(lower(p_type), 'small') AND p_size > 25))), []) AS matched_columns, contains(lower(p_name), 'small') AS meta_match, list_sort(list_distinct(list(2000 + p_size % 3))) AS years, count(*) AS file_count, CAST(sum(p_size) AS BIGINT) AS total_size_bytes FROM part GROUP BY 1),
h AS (SELECT * FROM e WHERE len(matched_columns) > 0 OR meta_match), n AS (SELECT count(*) AS total_count FROM h) SELECT h.*, total_count, total_count > 15 AS truncated FROM h, n ORDER BY slug LIMIT 15""",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    cols = F.array_sort(F.collect_set(F.when(F.col("p_size") > 25, F.struct(F.col("p_type").alias("name"), F.lit("metric").alias("role")))))
    entries = part.groupBy(F.col("p_name").alias("slug")).agg(cols.alias("columns")).withColumn("title", F.col("slug"))
    files = part.select(F.col("p_name").alias("slug"), F.lit("clean").alias("layer"), (F.col("p_size") % 3 + 2000).alias("year"), F.col("p_size").cast("long").alias("bytes"))
    return C.find(entries, "SMALL", files=files.unionByName(files.withColumn("layer", F.lit("mart"))), layer="clean")


@query("cat_resolve", "SELECT 'f' || o_orderkey AS path FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND year(o_orderdate) = 1995")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    files = o.select(F.col("o_orderpriority").alias("slug"), F.col("o_orderstatus").alias("layer"), F.year("o_orderdate").alias("year"), F.lit("t").alias("table"), (F.col("o_orderkey") % 2 == 0).alias("local"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("path"))
    return C.resolve(files, "1-URGENT", "F", 1995, "t").select("path")


def _columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("slug"), F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("column"), F.concat(F.lit("t"), (F.col("c_nationkey") % 4).cast("string")).alias("semantic_type")).distinct()


def _vocabulary(spark, sf_dir):
    return table(spark, sf_dir, "nation").filter("n_nationkey < 4").select(F.concat(F.lit("t"), F.col("n_nationkey").cast("string")).alias("semantic_type"), F.concat(F.lit("E"), (F.col("n_nationkey") % 2).cast("string")).alias("entity"))


_EDGES = "e AS (SELECT DISTINCT c_mktsegment AS slug, c_nationkey AS k, c_nationkey % 4 AS t, 'E' || (c_nationkey % 4 % 2) AS entity FROM customer)"


@query("gr_nodes", f"WITH {_EDGES} SELECT entity, count(*) AS n_datasets, count(DISTINCT t) AS n_types FROM e GROUP BY 1")
def _(spark, sf_dir):
    return C.graph_nodes(_columns(spark, sf_dir), _vocabulary(spark, sf_dir)).select("entity", F.size("datasets").cast("long").alias("n_datasets"), F.size("types").cast("long").alias("n_types"))


@query("gr_bridges", f"WITH {_EDGES} SELECT DISTINCT entity AS from_entity, 'E1' AS to_entity, 'ponte' AS bridge FROM e WHERE t = 0 AND entity <> 'E1'")
def _(spark, sf_dir):
    bridges = spark.createDataFrame([("t0", "E1", "ponte"), ("t1", "E1", "altro")], "semantic_type string, to_entity string, bridge string")
    return C.graph_bridges(_columns(spark, sf_dir), _vocabulary(spark, sf_dir), bridges)


@query(
    "gr_merge",
    f"""WITH {_EDGES}, h AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE slug = 'BUILDING'),
g AS (SELECT entity, count(*) AS n FROM h GROUP BY 1),
b AS (SELECT DISTINCT entity, 'E1:ponte' AS b FROM e WHERE t = 0 UNION SELECT DISTINCT entity, 'E9:altro' FROM e WHERE t = 1 AND slug = 'BUILDING' UNION SELECT DISTINCT entity, 'E1:terzo' FROM e WHERE t = 2 AND slug = 'BUILDING')
SELECT entity, (SELECT count(*) FROM e WHERE e.entity = g.entity) AS n_datasets, n, coalesce((SELECT list(b ORDER BY b) FROM b WHERE b.entity = g.entity), []) AS bridges FROM g
UNION ALL SELECT 'E9', 0, 0, [] FROM (SELECT count(*) AS k FROM e WHERE t = 1 AND slug = 'BUILDING') WHERE k > 0""",
)
def _(spark, sf_dir):
    """The graph of all customers with one bridge, and that of a segment with the same one and two more, one to an entity without a node."""
    every, some = _columns(spark, sf_dir), _columns(spark, sf_dir).filter("slug = 'BUILDING'")
    vocabulary = _vocabulary(spark, sf_dir)
    first = spark.createDataFrame([("t0", "E1", "ponte")], "semantic_type string, to_entity string, bridge string")
    second = spark.createDataFrame([("t0", "E1", "ponte"), ("t1", "E9", "altro"), ("t2", "E1", "terzo")], first.schema)
    nodes = C.graph_nodes(every, vocabulary).unionByName(C.graph_nodes(some, vocabulary))
    bridges = C.graph_bridges(every, vocabulary, first).unionByName(C.graph_bridges(some, vocabulary, second))
    total = F.aggregate("types", F.lit(0).cast("long"), lambda x, t: x + t["n"])
    return C.merge_graphs(nodes, bridges).select("entity", F.size("datasets").cast("long").alias("n_datasets"), total.alias("n"), F.transform("bridges", lambda b: F.concat_ws(":", b["to_entity"], b["bridge"])).alias("bridges"))


@query("gr_filter", f"WITH {_EDGES} SELECT entity, count(*) AS n FROM e WHERE t = 1 AND slug = 'BUILDING' GROUP BY 1")
def _(spark, sf_dir):
    nodes = C.graph_nodes(_columns(spark, sf_dir), _vocabulary(spark, sf_dir))
    return C.filter_graph(nodes, key="t1", dataset="BUILDING").select("entity", F.size("datasets").cast("long").alias("n"))
