"""Readers and writers over files that Spark writes from the tables into the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators.joins import union_by_name
from marblework.registry import query
from marblework.session import table
from marblework.sources import delimited as D
from marblework.sources import files as L
from marblework.sources.shared import shared_folder


def folder(spark) -> str:
    return shared_folder(spark, "sources")


def landed(spark, df, kind: str = "csv", **options) -> str:
    path = folder(spark)
    w = df.write.options(**options)
    (w.csv(path) if kind == "csv" else w.text(path) if kind == "text" else w.parquet(path))
    return path


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.format_number("c_acctbal", 2).alias("balance"), "c_mktsegment")


_COLUMNS = {"id": "chiave:BIGINT", "nome": "VARCHAR", "saldo": "DOUBLE", "segmento": "VARCHAR"}


@query("src_csv", "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment FROM customer")
def _(spark, sf_dir):
    path = landed(spark, table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), header=True, sep=";")
    got = D.read_csv(spark, [path], D.merged_options({"sep": ","}, {"sep": ";"}, {"nullstr": ["BUILDING", "MACHINERY"]}))
    return got.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment")


@query("src_csv_columns", "SELECT c_custkey AS chiave, c_name AS nome, round(c_acctbal, 2) AS saldo, c_mktsegment AS segmento FROM customer")
def _(spark, sf_dir):
    path = landed(spark, _customers(spark, sf_dir), header=True, sep="|")
    return D.read_csv(spark, [path], {"columns": _COLUMNS, "sep": "|", "thousands": ","}, mode="strict")


@query("src_csv_trim", "SELECT c_custkey AS chiave, c_name AS nome FROM customer")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" \t")).alias("n"))
    path = landed(spark, df, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return D.read_csv(spark, [path], {"columns": {"a": "chiave:BIGINT", "b": "nome:VARCHAR"}, "trim": True})


def _ragged(spark, sf_dir):
    k = F.col("c_custkey")
    line = F.concat(k.cast("string"), F.lit(";"), F.when(k % 5 == 0, F.lit("x;y;EXTRA")).when(k % 5 == 1, F.lit("x")).otherwise(F.concat(F.lit("x;"), F.col("c_nationkey").cast("string"))))
    return landed(spark, table(spark, sf_dir, "customer").select(line.alias("value")), kind="text")


_RAGGED = {"columns": {"a": "BIGINT", "b": "VARCHAR", "c": "VARCHAR"}, "sep": ";", "header": False}


@query("src_csv_modes", "SELECT c_custkey AS a, 'x' AS b, CASE WHEN c_custkey % 5 > 1 THEN CAST(c_nationkey AS VARCHAR) END AS c FROM customer WHERE c_custkey % 5 > 0")
def _(spark, sf_dir):
    return D.read_csv(spark, [_ragged(spark, sf_dir)], _RAGGED, mode="fallback")


@query("src_csv_bad_rows", "SELECT c_custkey || ';x;y;EXTRA' AS row FROM customer WHERE c_custkey % 5 = 0")
def _(spark, sf_dir):
    return D.bad_rows(spark, [_ragged(spark, sf_dir)], _RAGGED)


@query("src_csv_pad", "SELECT CAST(c_custkey AS VARCHAR) AS a, CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END AS b FROM customer")
def _(spark, sf_dir):
    line = F.concat(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ";x").otherwise(""))
    path = landed(spark, table(spark, sf_dir, "customer").select(line.alias("value")), kind="text")
    return D.read_padded(spark, [path], ["a", "b"], {"sep": ";", "header": False})


@query("src_csv_align", "SELECT c_name AS nome, CAST(c_custkey AS VARCHAR) AS id, '' AS manca FROM customer UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR), '' FROM supplier")
def _(spark, sf_dir):
    a = landed(spark, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"), F.lit("z").alias("altro")), header=True)
    b = landed(spark, table(spark, sf_dir, "supplier").select(F.col("s_name").alias("nome"), F.col("s_suppkey").alias("id")), header=True)
    return D.read_aligned(spark, [a, b], ["nome", "id", "manca"])


@query("src_union_by_name", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome, NULL AS saldo FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, CAST(s_nationkey AS VARCHAR) FROM supplier")
def _(spark, sf_dir):
    a = landed(spark, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")), header=True)
    b = landed(spark, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("saldo")), header=True)
    return D.union_by_header(spark, [a, b])


def _titled(spark, sf_dir):
    """A file for each hundred customers, of two title lines, a header and rows."""
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(";"), "c_name", F.lit(";"), F.col("c_nationkey").cast("string"), F.lit(",5"))
    files = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 100).alias("f")).agg(F.array_join(F.collect_list(line), "\n").alias("b"))
    path = folder(spark)
    L.write_each(files.select(F.concat(F.lit("Titolo\nFonte: x\nid;nome;quota\n"), "b").alias("value")), path)
    return path


@query("src_skip", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome, c_nationkey + 0.5 AS quota FROM customer")
def _(spark, sf_dir):
    columns = {"id": "VARCHAR", "nome": "VARCHAR", "quota": "DOUBLE"}
    return D.read_csv(spark, [_titled(spark, sf_dir)], {"columns": columns, "sep": ";", "skip": 2, "decimal": ","})


@query("src_csv_inferred", "SELECT c_custkey AS id, c_name AS nome, c_nationkey + 0.5 AS quota FROM customer")
def _(spark, sf_dir):
    """Names and types from files with title lines and decimal commas."""
    return D.read_csv(spark, [_titled(spark, sf_dir)], {"sep": ";", "skip": 2, "decimal": ",", "null_padding": True})


@query("src_csv_charset", "SELECT CAST(c_custkey AS VARCHAR) AS chiave, c_name || ' perché €' AS nome FROM customer")
def _(spark, sf_dir):
    """A CP1252 file: Latin-1 letters and the byte 128."""
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("chiave"), F.concat("c_name", F.lit(" perché \x80")).alias("nome"))
    path = landed(spark, df, header=True, encoding="ISO-8859-1")
    return D.read_csv(spark, [path], {"encoding": "cp1252", "auto_detect": False})


@query("src_inject", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 13 END AS cod_regione FROM customer")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "a.csv").otherwise("b.csv").alias("_file"))
    return D.inject(df, {"a.csv": {"cod_regione": 13}}).drop("_file")


@query("src_parquet", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf_dir):
    return spark.read.parquet(landed(spark, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), kind="parquet"))


@query("src_parquet_url_rows", "SELECT c_mktsegment AS slug, 'https://storage.googleapis.com/b/' || c_mktsegment || '.parquet' AS url, count(*) AS n FROM customer GROUP BY 1")
def _(spark, sf_dir):
    """Published Parquet by slug: the URL that a browser would use, and the rows of the landed file."""
    c = table(spark, sf_dir, "customer")
    path = folder(spark)
    c.select(F.col("c_mktsegment").alias("slug"), "c_name").write.partitionBy("slug").parquet(path)
    files = c.select(F.col("c_mktsegment").alias("slug"), F.concat(F.lit("s3://b/"), "c_mktsegment", F.lit(".parquet")).alias("url")).distinct()
    counts = spark.read.parquet(path).groupBy("slug").agg(F.count("*").alias("n"))
    return L.published(files).join(counts, "slug")


@query("src_gzip_text", "SELECT s_suppkey AS k, s_name AS n FROM supplier")
def _(spark, sf_dir):
    path = landed(spark, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), header=True, compression="gzip")
    return D.read_csv(spark, [path], {"columns": {"k": "BIGINT", "n": "VARCHAR"}})


@query("snk_parquet", "SELECT CAST(year(o_orderdate) AS INTEGER) AS anno, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf_dir):
    from marblework.plans.layers import write_layer

    path = folder(spark)
    write_layer(table(spark, sf_dir, "orders").withColumn("anno", F.year("o_orderdate")), path, ["anno"])
    return spark.read.parquet(path).groupBy("anno").agg(F.count("*").alias("n"))


@query("snk_metrics", "SELECT count(*) AS row_count, 2 AS column_count, TRUE AS has_bytes FROM supplier")
def _(spark, sf_dir):
    from marblework.plans.layers import write_layer

    said = write_layer(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), folder(spark))
    return table(spark, sf_dir, "supplier").limit(1).select(F.lit(said["row_count"]).cast("long").alias("row_count"), F.lit(said["column_count"]).alias("column_count"), F.lit(said["bytes"] > 0).alias("has_bytes"))


def _listing(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(F.concat("c_name", F.when(k % 3 == 0, ".csv").when(k % 3 == 1, ".pdf").otherwise(".csv.gz")).alias("name"), F.col("c_nationkey").alias("modified"), (k % 50).alias("bytes"))


_FILES = "f AS (SELECT c_name || CASE c_custkey % 3 WHEN 0 THEN '.csv' WHEN 1 THEN '.pdf' ELSE '.csv.gz' END AS name, c_nationkey AS modified, c_custkey % 50 AS bytes FROM customer), g AS (SELECT * FROM f WHERE bytes > 0 AND NOT ends_with(name, '.pdf'))"


@query("src_select", f"WITH {_FILES} SELECT 'all' AS mode, count(*) AS n, min(name) AS name FROM g UNION ALL SELECT 'latest', 1, (SELECT name FROM g ORDER BY modified DESC, lower(name) LIMIT 1) UNION ALL SELECT 'largest', 1, (SELECT name FROM g ORDER BY bytes DESC, lower(name) LIMIT 1)")
def _(spark, sf_dir):
    files = _listing(spark, sf_dir)
    one = lambda mode: L.select_inputs(files, mode).agg(F.lit(mode).alias("mode"), F.count("*").alias("n"), F.min("name").alias("name"))
    return union_by_name([one("all"), one("latest"), one("largest")])


@query("src_manifest", "SELECT sha256(CAST(s_suppkey AS VARCHAR) || chr(10)) AS sha256, octet_length(encode(s_suppkey || chr(10))) AS bytes, 'test' AS origin FROM supplier")
def _(spark, sf_dir):
    """A file for each supplier, its size and SHA-256."""
    path = folder(spark)
    L.write_each(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("value")), path)
    return L.manifest(spark, path, "test", "x").select("sha256", "bytes", "origin")


@query("src_raw_checks", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN ['empty'] WHEN 1 THEN list_concat(['html'], CASE WHEN b + 16 < 200 THEN ['tiny'] ELSE [] END) WHEN 2 THEN ['binary', 'tiny', 'one line'] ELSE CASE WHEN b + 4 < 200 THEN ['tiny'] ELSE []::VARCHAR[] END END AS problems FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS b FROM pages)")
def _(spark, sf_dir):
    """All pages, small ones too: as nothing, as a page, as bytes, as a table."""
    k = F.col("page_id") % 4
    html = F.replace(F.coalesce("html", F.lit("")), F.lit("\n"), F.lit(" "))
    content = F.when(k == 0, F.encode(F.lit(""), "UTF-8")).when(k == 1, F.encode(F.concat(F.lit("<!doctype html>"), html, F.lit("\n")), "UTF-8")).when(k == 2, F.unhex(F.lit("610062"))).otherwise(F.encode(F.concat(F.lit("x;y\n"), html), "UTF-8"))
    return table(spark, sf_dir, "pages").select("page_id", L.problems(F.lit("a.csv"), content).alias("problems"))


@query("src_primary", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders o WHERE (o_orderstatus = 'F') = (SELECT max(o_orderstatus = 'F') FROM orders i WHERE i.o_custkey = o.o_custkey) GROUP BY 1")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderstatus") == "F").alias("primary"), F.col("o_orderkey").alias("position"), "o_orderkey")
    return L.primary(o, ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("src_versioned", "SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 0 END AS version FROM customer")
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), "c_custkey")
    old = c.filter("c_custkey % 2 = 0").select("name", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("version"))
    return L.versioned(old, c).select("name", "version")


@query("src_year_filter", "SELECT n_name AS name, 'http://x/2023/' || n_nationkey || CASE WHEN n_regionkey = 1 THEN '?v=2' ELSE '' END AS url FROM nation WHERE n_nationkey % 3 <> 1")
def _(spark, sf_dir):
    k = F.col("n_nationkey")
    s = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.when(k % 3 == 1, 2022).when(k % 3 == 2, 2023).alias("year"), F.concat(F.lit("http://x/{year}/"), k.cast("string")).alias("url"), F.when(F.col("n_regionkey") == 1, F.create_map(F.lit(2023), F.lit("?v=2"))).alias("url_suffix_by_year"))
    return L.for_year(s, 2023)
