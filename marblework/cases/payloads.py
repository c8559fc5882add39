"""Payloads made of the tables' rows, read back into rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import payloads as P
from marblework.registry import query
from marblework.session import table


@query("nrm_sdmx_json", "SELECT n_nationkey, '2000' AS time, n_name AS area, CAST(n_regionkey AS DOUBLE) AS value FROM nation UNION ALL SELECT n_nationkey, '2001', n_name, CAST(n_nationkey AS DOUBLE) FROM nation")
def _(spark, sf_dir):
    said = F.format_string(
        '{"dataSets":[{"series":{"0":{"observations":{"0":[%d],"1":[%d]}}}}],"structure":{"dimensions":{"series":[{"id":"AREA","values":[{"id":"x%d","name":"%s"}]}],"observation":[{"id":"TIME","values":[{"id":"2000","name":"2000"},{"id":"2001","name":"2001"}]}]}}}',
        "n_regionkey", "n_nationkey", "n_nationkey", "n_name",
    )
    rows = P.sdmx_rows(table(spark, sf_dir, "nation").select("n_nationkey", said.alias("payload")))
    return rows.select("n_nationkey", F.col("dims")["TIME"].alias("time"), F.col("labels")["AREA"].alias("area"), "value")


_TSV = "SELECT o_orderkey, {p} AS year, {m} AS month, CASE WHEN o_orderkey % 3 = {r} THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS value, CASE WHEN o_orderkey % 3 = {r} THEN NULL ELSE 'd' END AS flag FROM orders"


@query("nrm_tsv_unpivot", _TSV.format(p=2024, m=1, r=0) + " UNION ALL " + _TSV.format(p=2024, m=2, r=1))
def _(spark, sf_dir):
    cell = lambda r: F.when(F.col("o_orderkey") % 3 == r, ": ").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(" d")))
    lines = table(spark, sf_dir, "orders").select(F.concat(F.lit("M,"), F.col("o_orderkey").cast("string"), F.lit("\t"), cell(0), F.lit("\t"), cell(1)).alias("line"))
    return P.tsv_rows(lines, "freq,key\\TIME_PERIOD\t2024-01\t2024-02").select(F.col("dims")["key"].cast("long").alias("o_orderkey"), "year", "month", "value", "flag")


@query("nrm_tsv_cell", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(o_custkey AS DOUBLE) WHEN 2 THEN CAST(o_custkey AS DOUBLE) ELSE NULL END AS value, CASE o_orderkey % 4 WHEN 1 THEN 'b' WHEN 3 THEN 'p' END AS flag FROM orders")
def _(spark, sf_dir):
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string")
    said = F.when(k == 0, ":").when(k == 1, F.concat(c, F.lit(" b"))).when(k == 2, F.concat(c, F.lit(" "))).otherwise("x1 p")
    return table(spark, sf_dir, "orders").select("o_orderkey", P.tsv_cell(said).alias("c")).select("o_orderkey", "c.value", "c.flag")


@query("nrm_sparql_json", "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS nation FROM customer")
def _(spark, sf_dir):
    nation = F.when(F.col("c_custkey") % 2 == 0, F.format_string(',"nation":{"type":"literal","value":"%d"}', "c_nationkey")).otherwise("")
    said = F.concat(F.format_string('{"head":{"vars":["name","nation"]},"results":{"bindings":[{"name":{"type":"literal","value":"%s"}', "c_name"), nation, F.lit("}]}}"))
    return P.sparql_rows(table(spark, sf_dir, "customer").select("c_custkey", said.alias("payload")), ["name", "nation"])


@query("nrm_ckan_records", "SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS key FROM nation WHERE n_nationkey < 20")
def _(spark, sf_dir):
    record = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("key"))
    pages = table(spark, sf_dir, "nation").groupBy(F.floor(F.col("n_nationkey") / 10).alias("page")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", record.alias("r")))).alias("rs"))
    said = F.to_json(F.struct(F.struct(F.lit(20).alias("total"), F.transform("rs", lambda x: x["r"]).alias("records")).alias("result")))
    return P.ckan_records(pages.select("page", said.alias("payload")), ["name", "key"]).select("name", "key")


@query("nrm_page_concat", "SELECT y AS page, n FROM (SELECT CAST(c_nationkey AS INTEGER) AS y, count(*) AS n FROM customer GROUP BY 1) WHERE y <= (SELECT min(y) FROM (SELECT c_nationkey AS y, count(*) AS n FROM customer GROUP BY 1) WHERE n < 60) AND n > 0 OR (SELECT min(y) FROM (SELECT c_nationkey AS y, count(*) AS n FROM customer GROUP BY 1) WHERE n < 60) IS NULL")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("page")).agg(F.count("*").alias("n"))
    return P.page_end(pages, 60, rows="n")


@query("nrm_keyset_last", "SELECT o_orderstatus, CAST(max(o_orderkey) AS VARCHAR) AS last, CAST(max(o_orderkey) AS VARCHAR) AS literal FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1")
def _(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderkey").cast("string"))
    return P.keyset_last(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", key.alias("k")), "k", "o_orderkey", ["o_orderstatus"])


@query("nrm_csv_data_rows", "SELECT c_nationkey, CAST(count(*) AS INTEGER) AS rows FROM customer GROUP BY 1")
def _(spark, sf_dir):
    row = F.concat(F.col("c_custkey").cast("string"), F.lit(',"a\nb "'))
    text = F.concat(F.lit("id,x\n"), F.array_join(F.collect_list(row), "\r\n"), F.lit("\n"))
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(text.alias("t")).select("c_nationkey", P.csv_data_rows(F.col("t")).alias("rows"))


@query("nrm_constraint_check", "SELECT 'nation' AS dim, CAST(c_nationkey AS VARCHAR) AS code, 'code not allowed' AS problem FROM customer WHERE c_nationkey > 19 GROUP BY 2 UNION ALL SELECT 'segment', c_mktsegment, 'unknown dimension' FROM customer GROUP BY 2")
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    filters = c.select(F.lit("nation").alias("dim"), F.col("c_nationkey").cast("string").alias("code")).union(c.select(F.lit("segment"), "c_mktsegment")).distinct()
    allowed = table(spark, sf_dir, "nation").filter("n_nationkey <= 19").select(F.lit("nation").alias("dim"), F.col("n_nationkey").cast("string").alias("code"))
    return P.constraint_check(filters, allowed)


def _resources(spark, sf_dir):
    format_ = F.element_at(F.array(*map(F.lit, ("XML", "CSV", "ZIP", "pdf"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    scheme = F.when(F.col("p_partkey") % 5 == 0, "ftp://x/").otherwise("http://x/")
    one = F.struct(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("").alias("name"), F.col("p_type").alias("description"), format_.alias("format"), F.concat(scheme, F.col("p_partkey").cast("string")).alias("url"))
    packages = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.to_json(F.struct(F.collect_list(one).alias("resources"))).alias("payload"))
    return P.ckan_resources(packages)


_RES = "r AS (SELECT p_brand, CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 2 = 0 AND p_name <> '' THEN p_name ELSE p_type END AS name, ['xml', 'csv', 'zip', 'pdf'][p_partkey % 4 + 1] AS format, 'http://x/' || p_partkey AS url FROM part WHERE p_partkey % 5 <> 0)"


@query("nrm_ckan_resources", f"WITH {_RES} SELECT * FROM r")
def _(spark, sf_dir):
    return _resources(spark, sf_dir)


@query("nrm_ckan_rank", f"WITH {_RES}, k AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE format WHEN 'csv' THEN 0 WHEN 'zip' THEN 1 WHEN 'xml' THEN 4 ELSE 9 END, name, id) AS n FROM r) SELECT p_brand, id, name, format, url FROM k WHERE n = 1")
def _(spark, sf_dir):
    return P.ckan_rank(_resources(spark, sf_dir), ["p_brand"])


@query("nrm_ckan_is_csv", f"WITH {_RES} SELECT id, format FROM r WHERE format IN ('csv', 'zip') AND NOT contains(lower(name), 'logcsv')")
def _(spark, sf_dir):
    return _resources(spark, sf_dir).filter(P.is_csv_resource(F.col("name"), F.col("format"))).select("id", "format")


@query("snk_codelist", "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS label_en, CASE WHEN n_nationkey % 2 = 0 THEN 'L' || n_regionkey ELSE '' END AS LEVEL FROM nation")
def _(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    note = F.struct(key, F.array(F.struct(F.lit("LEVEL").alias("type"), F.concat(F.lit("L"), F.col("n_regionkey").cast("string")).alias("title"))))
    one = n.agg(F.map_from_entries(F.collect_list(F.struct(key, "n_name"))).alias("label"), F.map_from_entries(F.collect_list(F.when(F.col("n_nationkey") % 2 == 0, note))).alias("notes"))
    said = F.to_json(F.struct(F.struct("label").alias("category"), F.struct(F.col("notes").alias("code-annotation")).alias("extension")))
    return P.codelist(one.select(said.alias("payload")))
