"""Format inference over files made of the tables' rows, one small file per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from marblework.operators import joins as J
from marblework.operators import profile as P
from marblework.operators import rollup as A
from marblework.registry import query
from marblework.session import table


def _files(spark, sf_dir):
    """A text per nation: a title line for odd keys, a header, a row per customer; separators and decimal marks by key."""
    sep = F.element_at(F.array(*map(F.lit, P.DELIMITERS)), (F.col("c_nationkey") % 4 + 1).cast("int"))
    number = F.format_string("%.2f", F.abs("c_acctbal"))
    balance = F.when(F.col("c_nationkey") % 4 == 0, F.replace(number, F.lit("."), F.lit(","))).otherwise(number)
    row = F.concat(F.col("c_custkey").cast("string"), sep, F.translate("c_name", "#", ""), sep, F.col("c_mktsegment"), sep, balance)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("r")))), lambda x: x["r"]), "\n")
    per = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(body.alias("b"))
    head = F.concat(F.lit("id"), sep, F.lit("nome"), sep, F.lit("segmento"), sep, F.lit("saldo"))
    title = F.when(F.col("c_nationkey") % 2 == 1, "Tabella clienti\n").otherwise("")
    return per.select(F.col("c_nationkey").alias("path"), F.concat(title, head, F.lit("\n"), "b").alias("text"))


@query("prf_delim", "SELECT c_nationkey AS path, [';', ',', chr(9), '|'][c_nationkey % 4 + 1] AS delimiter FROM customer GROUP BY 1")
def _(spark, sf_dir):
    return P.delimiter(P.numbered_lines(_files(spark, sf_dir)))


@query("prf_skip", "SELECT c_nationkey AS path, CAST(c_nationkey % 2 AS INTEGER) AS skip FROM customer GROUP BY c_nationkey")
def _(spark, sf_dir):
    lines = P.numbered_lines(_files(spark, sf_dir))
    return P.skip_lines(lines.join(P.delimiter(lines), "path"))


@query("prf_header_mismatch", "SELECT c_nationkey AS path, c_nationkey % 2 = 1 AS robust FROM customer GROUP BY c_nationkey")
def _(spark, sf_dir):
    lines = P.numbered_lines(_files(spark, sf_dir))
    return P.header_mismatch(lines.join(P.delimiter(lines), "path"))


@query("prf_decimal", "SELECT l_suppkey AS path, CASE l_suppkey % 5 WHEN 0 THEN ',' WHEN 1 THEN '.' WHEN 2 THEN ',' WHEN 3 THEN NULL ELSE ',' END AS decimal FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    """By supplier: commas, points, as many of both, no decimals, and 1.234,56 cut by a comma as the delimiter."""
    kind = F.col("l_suppkey") % 5
    number = F.format_string("%.2f", F.col("l_extendedprice"))
    said = (
        F.when(kind == 0, F.concat(F.lit("x;"), F.replace(number, F.lit("."), F.lit(","))))
        .when(kind == 1, F.concat(F.lit('x;"'), number, F.lit('"')))
        .when(kind == 2, F.concat(number, F.lit(";"), F.replace(number, F.lit("."), F.lit(","))))
        .when(kind == 3, F.concat(F.lit("x;"), F.col("l_partkey").cast("string")))
        .otherwise(F.concat(F.lit("x,1.234,"), F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0")))
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("path"), said.alias("line"), F.when(kind == 4, ",").otherwise(";").alias("delimiter"))
    return P.decimal_mark(lines)


@query(
    "prf_encoding",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'utf-8-sig' WHEN doc_id % 3 = 1 AND regexp_full_match(text, '[\\x{00}-\\x{FF}]*', 's') AND NOT regexp_full_match(text, '[\\x{00}-\\x{7F}]*', 's') THEN 'windows-1252' ELSE 'utf-8' END AS encoding FROM documents WHERE text IS NOT NULL""",
)
def _(spark, sf_dir):
    """All texts: with a mark, as ISO-8859-1 where it has all their characters, else as UTF-8."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))).when((F.col("doc_id") % 3 == 1) & F.col("text").rlike(r"^[\x00-\xFF]*\z"), F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return docs.select("doc_id", P.encoding(raw).alias("encoding"))


@query("prf_binary_kind", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'xls' WHEN 1 THEN 'zip' WHEN 2 THEN 'xlsx' END AS kind FROM pages")
def _(spark, sf_dir):
    head = F.unhex(F.element_at(F.array(F.lit("D0CF11E0A1B1"), F.lit("504B0304"), F.lit("504B0304786C2F"), F.lit("")), (F.col("page_id") % 4 + 1).cast("int")))
    return table(spark, sf_dir, "pages").select("page_id", P.binary_kind(F.concat(head, F.encode(F.translate("html", "[]/", ""), "UTF-8"))).alias("kind"))


_STEMS = ("codice", "prezzo", "quota", "nome_ente", "data")


def _cells(spark, sf_dir):
    """A column for each nation with customers, of one of five forms: codes, prices, shares, names with gaps, dates."""
    c = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    day = F.date_add(F.lit("2020-01-13").cast("date"), (key % 15).cast("int"))
    price = F.replace(F.format_string("%.2f", F.abs("c_acctbal") + 1), F.lit("."), F.lit(","))
    forms = [key.cast("string"), price, F.concat((key % 100).cast("string"), F.lit("%")), F.when(key % 2 == 0, "N/A").otherwise(F.col("c_mktsegment")), F.when(nation % 2 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))]
    pick = lambda values: F.element_at(F.array(*values), (nation % 5 + 1).cast("int"))
    return c.select(key.alias("n"), F.concat(pick(map(F.lit, _STEMS)), nation.cast("string")).alias("column"), pick(forms).alias("value"))


_KINDS = f"""k AS (SELECT c_nationkey AS n, {list(_STEMS)}[c_nationkey % 5 + 1] || c_nationkey AS c, count(*) FILTER (c_custkey % 2 = 0) AS gaps FROM customer GROUP BY 1),
t AS (SELECT n, c, CASE n % 5 WHEN 1 THEN 'number_it' WHEN 2 THEN 'percent_it' END AS kind, ['int', 'float', 'float', 'str', 'str'][n % 5 + 1] AS type,
  CASE WHEN n % 5 = 3 AND gaps > 0 THEN ['N/A'] ELSE []::VARCHAR[] END AS null_tokens, CASE n % 5 WHEN 3 THEN ['trim', 'title', 'collapse_spaces'] WHEN 4 THEN ['trim', 'collapse_spaces'] END AS normalize FROM k)"""


@query("prf_mapping", f'WITH {_KINDS} SELECT c AS "column", kind, type, null_tokens, normalize FROM t')
def _(spark, sf_dir):
    return P.column_kinds(_cells(spark, sf_dir))


for _name, _field in (("prf_value_kind", "kind"), ("prf_type", "type"), ("prf_null_tokens", "null_tokens"), ("prf_normalize_hint", "normalize")):
    query(_name, f'WITH {_KINDS} SELECT c AS "column", {_field} FROM t')(lambda spark, sf_dir, f=_field: P.column_kinds(_cells(spark, sf_dir)).select("column", f))


@query("prf_date_columns", f'WITH {_KINDS} SELECT c AS "column" FROM t WHERE n % 5 = 4')
def _(spark, sf_dir):
    return P.date_columns(_cells(spark, sf_dir))


@query(
    "prf_date_format",
    f"""WITH {_KINDS}, f AS (SELECT c, CASE n % 2 WHEN 0 THEN 'dd/MM/yyyy' ELSE 'yyyy-MM-dd' END AS format FROM t WHERE n % 5 = 4)
SELECT c AS "column", format, CASE WHEN (SELECT count(DISTINCT format) FROM f) = 1 THEN format END AS common, (SELECT min(format) FROM f WHERE c = 'data4') AS first FROM f""",
)
def _(spark, sf_dir):
    """The format of each date column, of all of them together, and of one."""
    found = P.date_formats(_cells(spark, sf_dir).filter("column LIKE 'data%'"))
    common = P.common_date_format(found).withColumnRenamed("format", "common")
    first = P.common_date_format(found.filter("column = 'data4'")).withColumnRenamed("format", "first")
    return found.crossJoin(F.broadcast(common)).crossJoin(F.broadcast(first))  # one row each


@query("prf_year_column", "SELECT CASE n_nationkey % 5 WHEN 0 THEN 'Anno' ELSE 'annoRiferimento' END AS name FROM nation WHERE n_nationkey % 5 < 2")
def _(spark, sf_dir):
    """Names of columns, two in five of them of a year."""
    k = F.col("n_nationkey") % 5
    return P.year_columns(table(spark, sf_dir, "nation").select(F.when(k == 0, "Anno").when(k == 1, "annoRiferimento").otherwise(F.col("n_name")).alias("name"))).select("name")


@query("prf_year_values", "SELECT 'anno' AS \"column\", CAST(min(year(o_orderdate)) AS INTEGER) AS low, CAST(max(year(o_orderdate)) AS INTEGER) AS high FROM orders")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("anno"), "o_orderstatus")
    return P.year_values(A.unpivoted(o, ["anno", "o_orderstatus"]))


@query("prf_read_hints", "SELECT c_nationkey AS path, [';', ',', chr(9), '|'][c_nationkey % 4 + 1] AS delimiter, 'utf-8' AS encoding, CASE WHEN c_nationkey % 4 = 0 THEN ',' ELSE '.' END AS decimal, CAST(c_nationkey % 2 AS INTEGER) AS skip FROM customer GROUP BY c_nationkey")
def _(spark, sf_dir):
    files = _files(spark, sf_dir)
    lines = P.numbered_lines(files)
    found = P.delimiter(lines)
    known = lines.join(found, "path")
    hints = P.read_hints(files.select("path", P.encoding(F.encode("text", "UTF-8")).alias("encoding")), found, P.decimal_mark(known), P.skip_lines(known), P.header_mismatch(known))
    return hints.select("path", "hints.delimiter", "hints.encoding", "hints.decimal", "hints.skip")


@query("prf_header_real", "SELECT n_nationkey, n_nationkey % 4 IN (0, 3) AS real FROM nation")
def _(spark, sf_dir):
    """All of three names known, a number among them, one known, two known."""
    name, k = F.col("n_name"), F.col("n_nationkey") % 4
    row = lambda *cells: F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells])
    first = F.when(k == 0, row("ID", " Nome", "valore")).when(k == 1, row("12", "nome", "id")).when(k == 2, row("id", name, "x")).otherwise(row("ID", "Nome", name))
    return table(spark, sf_dir, "nation").select("n_nationkey", P.header_real(first, row("id", "nome", "valore")).alias("real"))


_PROBES = {
    "pro_com": "municipality_code", "codice_belfiore": "cadastral_code", "comune": "municipality_name", "sigla_prov": "province_code", "regione": "region_code",
    "geo": "nuts_code", "piva": "fiscal_code", "ipa": "ipa_code", "cig": "cig_code", "cup": "cup_code", "ausa": "ausa_code", "cpv": "cpv_code", "cod_scuola": "school_code",
    "codice_ente": "siope_code", "codice_ente_miur": "miur_code", "codice_ente_ssn": "ssn_code", "username": "sogei_code", "ateco": "ateco_code", "paese": "country_code",
    "Anno": "year", "mese": "month", "person_id": "person_id", "senatore_id": "senator_id", "id_ddl": "ddl_id", "gruppo": "gruppo_parlamentare", "n_ricorso": "ricorso_number",
}


_NAMED = [*_PROBES, "valore", "etichetta"]


@query(
    "prf_roles",
    f"""WITH p AS (SELECT DISTINCT {_NAMED}[p_partkey % {len(_NAMED)} + 1] AS name, CASE WHEN p_size % 2 = 0 THEN 'string' ELSE 'double' END AS type FROM part),
k(name, kind) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _PROBES.items())})
SELECT name, type, CASE WHEN kind IS NOT NULL OR type = 'string' THEN 'dimension' ELSE 'metric' END AS role, kind AS semantic_type FROM p LEFT JOIN k USING (name)""",
)
def _(spark, sf_dir):
    """Columns that parts name, as texts and as numbers: one name for each semantic type and two of none."""
    name = F.element_at(F.array(*map(F.lit, _NAMED)), (F.col("p_partkey") % len(_NAMED) + 1).cast("int"))
    columns = table(spark, sf_dir, "part").select(name.alias("name"), F.when(F.col("p_size") % 2 == 0, "string").otherwise("double").alias("type")).distinct()
    return P.roles(columns).select("name", "type", "role", "semantic_type")


@query(
    "prf_batch_profiles",
    """WITH v AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 'b-repo' ELSE 'c-repo' END AS repo, o_orderpriority AS slug, CAST(year(o_orderdate) AS INTEGER) AS year, 'stato' AS c, o_orderstatus AS value FROM orders WHERE NOT (o_custkey % 3 = 0 AND o_orderpriority = '1-URGENT')),
k AS (SELECT slug, min(repo) AS repo FROM v GROUP BY 1), y AS (SELECT v.slug, v.repo, max(year) AS year FROM v JOIN k ON v.slug = k.slug AND v.repo = k.repo GROUP BY 1, 2),
g AS (SELECT v.slug, v.repo, v.year, c, value, count(*) AS n FROM v JOIN y ON v.slug = y.slug AND v.repo = y.repo AND v.year = y.year GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY slug, c ORDER BY n DESC, value) AS INTEGER) AS rank FROM g) SELECT slug, repo, year, c AS "column", value, n, rank FROM r WHERE rank <= 2""",
)
def _(spark, sf_dir):
    """Datasets by priority in two repositories, one of them in the second only."""
    third = F.col("o_custkey") % 3 == 0
    o = table(spark, sf_dir, "orders").filter(~(third & (F.col("o_orderpriority") == "1-URGENT")))
    values = o.select(F.when(third, "b-repo").otherwise("c-repo").alias("repo"), F.col("o_orderpriority").alias("slug"), F.year("o_orderdate").alias("year"), F.lit("stato").alias("column"), F.col("o_orderstatus").alias("value"))
    return P.batch_profiles(values, 2)


@query(
    "prf_source_preview",
    """SELECT ';' AS delimiter, 'utf-8' AS encoding, ',' AS decimal, 1 AS skip, count(*) AS row_count, CAST(min(year(o_orderdate)) AS INTEGER) AS low, CAST(max(year(o_orderdate)) AS INTEGER) AS high, 'regione' AS level,
['anno:bigint:dimension:year', 'importo:double:metric:', 'regione:string:dimension:region_code'] AS columns, 5 AS shown, TRUE AS graded FROM orders""",
)
def _(spark, sf_dir):
    """Files of orders with a title line, decimal commas and a year column."""
    from marblework.cases.sources import folder
    from marblework.plans.preview import source_preview
    from marblework.sources.files import write_each

    price = F.replace(F.format_string("%.2f", F.col("o_totalprice")), F.lit("."), F.lit(","))
    line = F.concat(F.year("o_orderdate").cast("string"), F.lit(";R"), (F.col("o_custkey") % 20).cast("string"), F.lit(";"), price)
    files = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 20000).alias("f")).agg(F.array_join(F.collect_list(line), "\n").alias("b"))
    path = folder(spark)
    write_each(files.select(F.concat(F.lit("Ordini\nanno;regione;importo\n"), "b").alias("value")), path)
    got = source_preview(spark, [path], "orders")
    said = F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["type"], c["role"], F.coalesce(c["semantic_type"], F.lit(""))))
    return got.select("delimiter", "encoding", "decimal", "skip", "row_count", "low", "high", "level", said.alias("columns"), F.size("sample").alias("shown"), F.col("verdict").isin("good", "acceptable", "poor").alias("graded"))
