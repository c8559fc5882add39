"""Cleaning functions over strings made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.functions import text as X
from marblework.registry import query
from marblework.session import table

_ITALIAN = "(CASE WHEN l_linenumber = 7 THEN 'abc' ELSE replace(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), '9', '.9') || ',' || lpad(CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR), 2, '0') END)"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_ITALIAN.replace("VARCHAR", "STRING")).alias("v"))


_CLEAN = "replace(replace(v, '.', ''), ',', '.')"
_FROM = f"FROM (SELECT l_orderkey, l_linenumber, {_ITALIAN} AS v FROM lineitem)"


@query("fn_normalize_italian_number", f"SELECT l_orderkey, l_linenumber, TRY_CAST({_CLEAN} AS DOUBLE) AS n {_FROM}")
def _(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", X.normalize_italian_number(F.col("v")).alias("n"))


@query("fn_normalize_italian_integer", f"SELECT l_orderkey, l_linenumber, TRY_CAST({_CLEAN} AS INTEGER) AS n {_FROM}")
def _(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", X.normalize_italian_integer(F.col("v")).alias("n"))


@query("fn_remove_dot_thousands", f"SELECT l_orderkey, l_linenumber, TRY_CAST(replace(v, '.', '') AS DOUBLE) AS n FROM (SELECT l_orderkey, l_linenumber, replace({_ITALIAN}, ',', '.') AS v FROM lineitem)")
def _(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", X.remove_dot_thousands(F.replace("v", F.lit(","), F.lit("."))).alias("n"))


@query("fn_normalize_string", "SELECT c_custkey, NULLIF(TRIM(CASE WHEN c_custkey % 3 = 0 THEN '   ' ELSE '  ' || c_name || ' ' END), '') AS s FROM customer")
def _(spark, sf_dir):
    raw = F.when(F.col("c_custkey") % 3 == 0, "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return table(spark, sf_dir, "customer").select("c_custkey", X.normalize_string(raw).alias("s"))


_FRACTION = "CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE CAST(c_custkey AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR) END"


@query("fn_cast_int", f"SELECT c_custkey, TRY_CAST({_FRACTION} AS INTEGER) AS n FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.cast_int(F.expr(_FRACTION.replace("VARCHAR", "STRING"))).alias("n"))


@query("fn_cast_bigint", f"SELECT c_custkey, TRY_CAST({_FRACTION} AS BIGINT) AS n FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.cast_bigint(F.expr(_FRACTION.replace("VARCHAR", "STRING"))).alias("n"))


@query("fn_cast_double", f"SELECT c_custkey, TRY_CAST({_FRACTION} || CASE WHEN c_custkey % 7 = 0 THEN 'd' ELSE '' END AS DOUBLE) AS n FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.cast_double(F.expr(_FRACTION.replace("VARCHAR", "STRING") + " || CASE WHEN c_custkey % 7 = 0 THEN 'd' ELSE '' END")).alias("n"))


@query("fn_decode_flag", "SELECT l_orderkey, l_linenumber, COALESCE(TRIM(NULLIF(' ' || l_returnflag, ' N')) = 'R', FALSE) AS returned FROM lineitem")
def _(spark, sf_dir):
    flag = F.nullif(F.concat(F.lit(" "), "l_returnflag"), F.lit(" N"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.decode_flag(flag, "R").alias("returned"))


_RAW = "CASE p_partkey % 6 WHEN 0 THEN '***' WHEN 1 THEN '\"' || p_size || ',00\"' WHEN 2 THEN ' 1.' || lpad(CAST(p_size AS VARCHAR), 3, '0') || ',5' WHEN 3 THEN 'N.D.' WHEN 4 THEN '2.' || lpad(CAST(p_size AS VARCHAR), 3, '0') ELSE p_brand END"
_TRIMMED = "trim(trim(v), '\"')"


@query(
    "fn_normalize_number",
    f"""WITH r AS (SELECT p_partkey, {_RAW} AS v FROM part), t AS (SELECT p_partkey, {_TRIMMED} AS t FROM r),
p AS (SELECT *, CASE WHEN contains(t, ',') THEN regexp_replace(replace(replace(t, '.', ''), ',', '.'), '\\.00?$', '') ELSE replace(t, '.', '') END AS n FROM t)
SELECT p_partkey, CASE WHEN t IN ('', '***', '-', 'N.D.') OR NOT regexp_full_match(n, '-?[0-9]*\\.?[0-9]*') OR NOT regexp_matches(n, '[0-9]') THEN NULL ELSE n END AS n FROM p""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.normalize_number(F.expr(_RAW.replace("VARCHAR", "STRING"))).alias("n"))


@query("fn_snake_case", "SELECT p_partkey, trim(lower(regexp_replace(regexp_replace(p_type || ' firstName', '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g')), '_') AS s FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.snake_case(F.concat("p_type", F.lit(" firstName"))).alias("s"))


@query("fn_colname_ws", "SELECT p_partkey, trim(regexp_replace('  ' || p_name || '   x  ', '\\s+', ' ', 'g')) AS s FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.collapse_spaces(F.concat(F.lit("  "), "p_name", F.lit("   x  "))).alias("s"))


@query("fn_match_key", "SELECT p_partkey, trim(regexp_replace(upper(p_brand || '--' || p_type), '[^A-Z0-9]+', '_', 'g'), '_') AS k FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.match_key(F.concat("p_brand", F.lit("--"), "p_type")).alias("k"))


@query("fn_norm_header", "SELECT p_partkey, replace(translate(lower(trim(p_type || '-L''x')), '- ', '__'), '''', '') AS h FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.normalize_header(F.concat("p_type", F.lit("-L'x"))).alias("h"))


@query("fn_decode_bytes", "SELECT doc_id, text AS t FROM documents")
def _(spark, sf_dir):
    marked = F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))
    raw = F.when(F.col("doc_id") % 3 == 0, marked).when((F.col("doc_id") % 3 == 1) & F.col("text").rlike("^[\\x00-\\x7F\\xA0-\\xFF]*$"), F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return table(spark, sf_dir, "documents").select("doc_id", X.decode_bytes(raw).alias("t"))


@query("fn_json_safe", "SELECT o_orderkey, '{\"value\":\"' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '\"}' AS j FROM orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.json_safe(F.to_date("o_orderdate")).alias("j"))


@query(
    "fn_hub_normalizers",
    """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS direct, lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS lpad6, right('000000' || c_custkey, 6) AS right6,
upper(trim(' ' || c_mktsegment || ' ')) AS upper_trim, replace(upper('cita'' ' || c_name), 'A''', 'À') AS accented, c_mktsegment AS unbracketed, lower(c_name) AS lower_name FROM customer""",
)
def _(spark, sf_dir):
    n = X.HUB_NORMALIZERS
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        n["direct"](F.col("c_nationkey")).alias("direct"),
        n["lpad6"](F.col("c_nationkey")).alias("lpad6"),
        n["right6"](F.concat(F.lit("000000"), F.col("c_custkey").cast("string"))).alias("right6"),
        n["upper_trim"](F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("upper_trim"),
        n["accented"](F.concat(F.lit("cita' "), "c_name")).alias("accented"),
        n["unbracketed"](F.concat(F.lit("["), "c_mktsegment", F.lit("]"))).alias("unbracketed"),
        n["lower"](F.col("c_name")).alias("lower_name"),
    )


@query(
    "fn_years_in_text",
    """SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN year(o_orderdate) WHEN 1 THEN 2010 + o_orderkey % 10 ELSE 2001 END AS INTEGER) AS low,
CAST(CASE o_orderkey % 3 WHEN 0 THEN year(o_orderdate) WHEN 1 THEN 2020 + o_orderkey % 10 ELSE 2019 END AS INTEGER) AS high FROM orders""",
)
def _(spark, sf_dir):
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, F.concat(F.lit("file_"), F.year("o_orderdate").cast("string"), F.lit("_x.csv"))).when(k % 3 == 1, F.concat((k % 10 + 2010).cast("string"), (k % 10 + 2020).cast("string"))).otherwise(F.lit("dal 2001-2019, n. 12345"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.years_in(said).alias("y")).select("o_orderkey", "y.low", "y.high")


@query(
    "fn_suggest_years",
    """SELECT o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN list_sort(list_distinct(list(CAST(year(o_orderdate) AS INTEGER))))
WHEN o_orderpriority = '2-HIGH' THEN [2018, 2019, 2020, 2021] WHEN o_orderpriority = '3-MEDIUM' THEN [2015] ELSE [2024] END AS years FROM orders GROUP BY 1""",
)
def _(spark, sf_dir):
    p = F.col("o_orderpriority")
    names = F.when(p == "2-HIGH", F.array(F.lit("pop_2018"), F.lit("pop_2021"))).when(p == "3-MEDIUM", F.array(F.lit("id"), F.lit("y2015"))).otherwise(F.array(F.lit("valore")))
    per = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.collect_set(F.when(p == "1-URGENT", F.year("o_orderdate"))).alias("ys"))
    return per.select("o_orderpriority", X.suggested_years(F.col("ys"), names).alias("years"))


_LEVEL = "CASE n_regionkey WHEN 0 THEN 'dati per comune di ' WHEN 1 THEN 'tabella provinciale ' WHEN 2 THEN 'la regione ' WHEN 3 THEN 'conto nazionale ' ELSE 'serie ' END || n_name"


@query("fn_granularity", "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'comune' WHEN 1 THEN 'provincia' WHEN 2 THEN 'regione' WHEN 3 THEN 'nazionale' ELSE 'non_determinato' END AS level FROM nation")
def _(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", X.granularity(F.expr(_LEVEL)).alias("level"))


@query(
    "fn_topics",
    """SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'lavoro' WHEN 1 THEN 'turismo' WHEN 2 THEN 'casa' ELSE 'sanita' END AS topic, CASE n_regionkey WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 3 END AS score FROM nation WHERE n_regionkey < 4""",
)
def _(spark, sf_dir):
    said = F.expr("CASE n_regionkey WHEN 0 THEN 'Salario e impiego' WHEN 1 THEN 'Turismo: arrivo, albergo' WHEN 2 THEN 'Alloggio' WHEN 3 THEN 'Salute in ospedale' ELSE 'xyz' END")
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(X.topic_scores(said)).alias("t")).select("n_nationkey", "t.topic", "t.score")


@query("fn_clean_filename", "SELECT o_orderkey, lower(o_orderpriority) AS slug, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 2 = 0")
def _(spark, sf_dir):
    name = F.concat(F.lower("o_orderpriority"), F.lit("_"), F.year("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "_clean.parquet").otherwise("_raw.parquet"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.clean_filename(name).alias("f")).filter("f IS NOT NULL").select("o_orderkey", "f.slug", "f.year")


@query(
    "fn_labels",
    """SELECT c_mktsegment, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' Data' AS title, CASE WHEN min(c_nationkey) = max(c_nationkey) THEN 'anno ' || min(c_nationkey) ELSE 'anni ' || min(c_nationkey) || '-' || max(c_nationkey) END AS span FROM customer GROUP BY 1""",
)
def _(spark, sf_dir):
    per = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.collect_set("c_nationkey").alias("ys"))
    return per.select("c_mktsegment", X.title_label(F.concat("c_mktsegment", F.lit("_data"))).alias("title"), X.years_label(F.col("ys")).alias("span"))


@query("fn_columns_map", "SELECT o_orderkey AS key, o_totalprice AS price, o_orderdate AS day FROM orders")
def _(spark, sf_dir):
    return X.columns_map(table(spark, sf_dir, "orders"), [(r"orderkey$", "key"), (r"price", "price"), (r"date$", "day"), (r"key", "key")])


@query("fn_sql_functions", f"SELECT l_orderkey, l_linenumber, TRY_CAST({_CLEAN} AS DOUBLE) AS number, TRY_CAST({_CLEAN} AS INTEGER) AS whole {_FROM}")
def _(spark, sf_dir):
    X.register_sql(spark)
    return spark.sql("SELECT l_orderkey, l_linenumber, normalize_italian_number(v) AS number, normalize_italian_integer(v) AS whole FROM {lines}", lines=_lines(spark, sf_dir))
