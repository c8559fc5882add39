"""Quality checks over three files: customers with the lines of all documents, parts with other faults, and an empty one.

The expected statuses are the rules said in SQL over the tables; between them the
files show both outcomes of nearly every check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from marblework.operators import quality as Q
from marblework.operators.numbering import with_start
from marblework.registry import query
from marblework.session import table


def _cells(spark, sf_dir):
    """Customers with seeded faults: repeated rows, blanks, comma decimals, dates by day first."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("n"),
        F.floor(k / 2).cast("string").alias("customer_id"),
        F.when(k % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("nome"),
        F.replace(F.format_string("%.1f", F.col("c_nationkey") + 0.5), F.lit("."), F.lit(",")).alias("importo totale"),
        F.lit("01/02/2023").alias("data"),
        F.when(k % 3 == 0, "x").otherwise(F.col("c_nationkey").cast("string")).alias("regione"),
    )


def _lines(spark, sf_dir):
    """All lines of all texts as one file: n counts from 1 through the texts by id, without gaps."""
    k = F.col("doc_id")
    texts = table(spark, sf_dir, "documents").select(k, F.concat(F.when(k % 50 == 7, "caffÃ¨ \x01").otherwise(""), F.coalesce("text", F.lit(""))).alias("_text"))
    lines = F.split("_text", "\n")
    placed = with_start(texts, ["doc_id"], F.size(lines))
    return placed.select("start", F.posexplode(lines).alias("_place", "line")).select((F.col("start") + F.col("_place") + 1).alias("n"), "line")


def _rows(cells):
    """The table's own lines: its header before all rows, fields quoted where they need it."""
    names = [c for c in cells.columns if c != "n"]
    body = cells.select("n", F.to_csv(F.struct(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names]), {"sep": ";"}).alias("line"))
    return body.unionByName(cells.sparkSession.range(1).select(F.lit(-1).cast("long").alias("n"), F.lit(";".join(names)).alias("line")))


_PARTS = ["id", "id", " ", "col1", "codice istat", "cig", "va!ore", "pagina", "attivo"]


def _parts(spark, sf_dir):
    """(lines, cells) of a file of parts: a mark, a header that repeats and leaves blank, ragged lines, unreadable characters, blank rows, a far value, long cells, a comment at the end."""
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    uuid = F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(k.cast("string"), 12, "0"))
    values = [k.cast("string"), uuid, F.col("p_brand"), size, F.lpad(size, 6, "0"), F.when(k % 97 == 5, F.repeat(F.lit("x"), 600)).otherwise(F.col("p_name")), F.when(k % 1000 == 1, "999999999").otherwise(size), F.concat(F.lit("https://dati.gov.it/x/"), k.cast("string")), (k % 2).cast("string")]
    cells = p.select(k.alias("n"), *[F.when(k % 50 == 3, "").otherwise(v).alias(f"c{i}") for i, v in enumerate(values)])
    body = F.concat(F.concat_ws(";", *[f"c{i}" for i in range(len(values))]), F.when(F.col("n") % 40 == 7, ";extra").otherwise(""), F.when(F.col("n") % 60 == 11, "\ufffd").otherwise(""))
    last = p.agg((F.max("p_partkey") + 3).alias("n")).select("n", F.lit("# fine").alias("line"))
    head = spark.range(1).select(F.lit(1).cast("long").alias("n"), F.lit("\ufeff" + ";".join(_PARTS)).alias("line"))
    return cells.select((F.col("n") + 2).alias("n"), body.alias("line")).unionByName(head).unionByName(last), cells


def _empty(spark, sf_dir):
    """(lines, cells) of a file of blank lines, as many as there are regions."""
    r = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("long").alias("n"), F.lit("").alias("line"))
    return r, r.filter("line <> ''").select("n", F.col("line").alias("foo"), F.col("line").alias("bar"))


def files(spark, sf_dir, only=()):
    """{file: its checks}."""
    customers = _cells(spark, sf_dir)
    rows = _rows(customers)
    of_lines = not only or any(i in Q.NEEDS["lines"] for i in only)
    return {
        "customers": Q.checks(_lines(spark, sf_dir) if of_lines else rows, customers, rows=rows, only=only),
        "parts": Q.checks(*_parts(spark, sf_dir), headers=_PARTS, only=only),
        "empty": Q.checks(*_empty(spark, sf_dir), only=only),
    }


def _all(frames):
    return reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(name).alias("file"), *df.columns) for name, df in frames.items()])


def found(spark, sf_dir, only=()):
    return _all(files(spark, sf_dir, only))


_SEEDED = """WITH k AS (SELECT c_custkey // 2 AS customer_id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS nome, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS regione FROM customer),
s AS (SELECT count(*) AS rows, count(DISTINCT customer_id) AS ids, count(*) FILTER (nome = '') / (5.0 * count(*)) AS empty, count(*) FILTER (regione <> 'x') / count(*) AS numeric, (SELECT count(*) - count(DISTINCT (customer_id, nome, c_nationkey, regione)) FROM k) AS dup FROM k),
l AS (SELECT count(*) FILTER (doc_id % 50 = 7) AS odd FROM documents),
v AS (SELECT p_partkey, p_partkey % 50 = 3 AS blank, CASE WHEN p_partkey % 1000 = 1 THEN 999999999 ELSE p_size END AS amount FROM part),
m AS (SELECT avg(amount) AS mean, stddev_samp(amount) AS sd, count(*) AS numbers FROM v WHERE NOT blank),
p AS (SELECT count(*) AS p_rows, count(*) FILTER (blank) AS p_blank, count(*) FILTER (p_partkey % 40 = 7 AND NOT blank) AS p_ragged, count(*) FILTER (p_partkey % 60 = 11) AS p_odd, count(*) FILTER (p_partkey % 97 = 5 AND NOT blank) AS p_long,
  count(*) FILTER (NOT blank AND numbers >= 10 AND abs(amount - mean) > 4 * sd) AS p_far, count(*) FILTER (NOT blank AND p_partkey <= 10) AS p_uuid, count(*) FILTER (NOT blank AND p_partkey <= 30) AS p_early FROM v, m)"""
#: For each check: the statuses of customers, of parts and of the empty file.
_STATUS = {
    "S1": ("'pass'", "'pass'", "'fail'"),
    "S2": ("'pass'", "'pass'", "'warn'"),
    "S3": ("'pass'", "'pass'", "'pass'"),
    "S4": ("'pass'", "'fail'", "'pass'"),
    "S5": ("'pass'", "'warn'", "'pass'"),
    "S6": ("'pass'", "CASE WHEN p_ragged + 1 > 0 THEN 'fail' ELSE 'pass' END", "'warn'"),
    "S7": ("'info'", "'info'", "'info'"),
    "S8": ("'pass'", "CASE WHEN p_odd > 0 THEN 'fail' ELSE 'pass' END", "'pass'"),
    "S9": ("CASE WHEN odd > 0 THEN 'fail' ELSE 'pass' END", "'pass'", "'pass'"),
    "S10": ("'pass'", "'warn'", "'pass'"),
    "S11": ("CASE WHEN odd > 0 THEN 'warn' ELSE 'pass' END", "'pass'", "'pass'"),
    "S12": ("'pass'", "CASE WHEN p_blank > 0 THEN 'warn' ELSE 'pass' END", "'pass'"),
    "C0": ("'pass'", "'pass'", "'skip'"),
    "C1": ("CASE WHEN dup > 0 THEN 'warn' ELSE 'pass' END", "CASE WHEN p_blank > 1 THEN 'warn' ELSE 'pass' END", "'skip'"),
    "C2": ("CASE WHEN empty > 0.3 THEN 'fail' WHEN empty > 0.1 THEN 'warn' ELSE 'pass' END", "CASE WHEN p_blank > 0.3 * p_rows THEN 'fail' WHEN p_blank > 0.1 * p_rows THEN 'warn' ELSE 'pass' END", "'skip'"),
    "C3": ("CASE WHEN ids < rows * 0.98 THEN 'warn' ELSE 'pass' END", "'pass'", "'skip'"),
    "C4": ("CASE WHEN numeric > 0.5 AND numeric < 0.9 THEN 'warn' ELSE 'pass' END", "'pass'", "'skip'"),
    "C5": ("'warn'", "'pass'", "'skip'"),
    "C6": ("'warn'", "'pass'", "'skip'"),
    "C7": ("'pass'", "CASE WHEN p_far > 0 THEN 'warn' ELSE 'pass' END", "'skip'"),
    "C8": ("'pass'", "CASE WHEN p_long > 0 THEN 'warn' ELSE 'pass' END", "'skip'"),
    "O1": ("CASE WHEN rows < 10 THEN 'warn' ELSE 'pass' END", "CASE WHEN p_rows < 10 THEN 'warn' ELSE 'pass' END", "'warn'"),
    "O2": ("'pass'", "'pass'", "'warn'"),
    "O3": ("'pass'", "'warn'", "'pass'"),
    "O4": ("'warn'", "'warn'", "'pass'"),
    "O5": ("'pass'", "'pass'", "'info'"),
    "O6": ("'pass'", "'info'", "'info'"),
    "O7": ("'pass'", "'warn'", "'pass'"),
    "O8": ("'info'", "CASE WHEN p_blank < p_rows THEN 'pass' ELSE 'info' END", "'info'"),
    "O9": ("'pass'", "CASE WHEN p_early > 0 THEN 'info' ELSE 'pass' END", "'pass'"),
    "O10": ("'pass'", "'warn'", "'pass'"),
    "L1": ("'info'", "CASE WHEN p_uuid > 0 THEN 'pass' ELSE 'info' END", "'info'"),
    "L2": ("'pass'", "'pass'", "'warn'"),
    "L3": ("'info'", "'pass'", "'info'"),
    "L4": ("'info'", "'pass'", "'info'"),
    "L5": ("'info'", "CASE WHEN p_early > 0 THEN 'pass' ELSE 'info' END", "'info'"),
    "L6": ("'pass'", "'pass'", "'info'"),
}
_FILES = ("customers", "parts", "empty")
_each = lambda ids: " UNION ALL ".join(f"SELECT '{f}' AS file, '{k}' AS id, {v} AS status FROM s, l, p" for k in ids for f, v in zip(_FILES, _STATUS[k], strict=True))
_ALL = _SEEDED + f", r AS ({_each(_STATUS)})"

query("qs_checks", _ALL + " SELECT file, id, status FROM r")(found)
for _id in _STATUS:
    query(f"qs_{_id}", f"{_SEEDED} {_each([_id])}")(lambda spark, sf_dir, i=_id: found(spark, sf_dir, (i,)))

_W = "CASE status WHEN 'pass' THEN 1.0 WHEN 'warn' THEN 0.5 WHEN 'fail' THEN 0.0 WHEN 'info' THEN 1.0 END"
_MEAN = "CAST(coalesce(round(avg({w}){f} * 100), 0) AS INTEGER)"
_SCORED = _ALL + f""", w AS (SELECT file, {_MEAN.format(w=_W, f=" FILTER (id[1] IN ('S', 'C'))")} AS structural, {_MEAN.format(w=_W, f=" FILTER (id[1] IN ('O', 'L'))")} AS semantic, {_MEAN.format(w=_W, f="")} AS combined,
count(*) FILTER (id IN ('S1', 'S3', 'S6') AND status = 'fail') > 0 AS critical, count(*) FILTER (id[1] IN ('S', 'C') AND status = 'fail') AS f, count(*) FILTER (id[1] IN ('S', 'C') AND status = 'warn') AS v FROM r GROUP BY file)"""


@query("qs_score", _SCORED + " SELECT file, structural, semantic, combined, critical FROM w")
def _(spark, sf_dir):
    return _all({name: Q.score(df).drop("verdict") for name, df in files(spark, sf_dir).items()})


@query("qs_verdict", _SCORED + " SELECT file, CASE WHEN critical OR f > 3 THEN 'poor' WHEN f > 0 OR v > 5 THEN 'acceptable' ELSE 'good' END AS verdict FROM w")
def _(spark, sf_dir):
    return _all({name: Q.score(df).select("verdict") for name, df in files(spark, sf_dir).items()})


@query(
    "qs_flags",
    _ALL
    + """ SELECT file, list_sort(list_distinct(list(CASE WHEN id IN ('S8', 'S9') AND status = 'fail' THEN 'encoding_issues' WHEN id = 'S4' AND status = 'fail' THEN 'duplicate_columns' WHEN id = 'S6' AND status = 'fail' THEN 'inconsistent_columns'
WHEN id = 'C2' AND status = 'fail' THEN 'high_missing_rate' WHEN id = 'O4' AND status = 'warn' THEN 'column_naming' WHEN id = 'C5' AND status = 'warn' THEN 'non_iso_dates' END))) AS flags FROM r GROUP BY file""",
)
def _(spark, sf_dir):
    return _all({name: Q.flags(df) for name, df in files(spark, sf_dir).items()})


@query(
    "qs_families",
    """WITH f AS (SELECT c_custkey AS path, unnest(CASE c_nationkey % 4 WHEN 0 THEN ['CLV', 'ISTAT', 'QB (DataCube)'] WHEN 1 THEN ['CPV (Person)', 'PC (PublicContract)'] WHEN 2 THEN ['CLV (Coordinate)', 'CLV (Address)'] ELSE ['ACCO (Accommodation)', 'SAN (Health)', 'POI (Points of Interest)', 'CULTURAL-ON'] END) AS o FROM customer)
SELECT path, split_part(o, ' ', 1) AS family, list_sort(list_distinct(list(o))) AS ontologies FROM f GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """The header line of a file for each customer, cut into its headers."""
    k = F.col("c_nationkey") % 4
    line = F.when(k == 0, "Codice Comune;valore").when(k == 1, "nome;cig;x").when(k == 2, "indirizzo;x1;lat").otherwise("posti-letto;museo")
    headers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("path"), F.explode(F.split(line, ";")).alias("header"))
    return Q.families(headers)
