"""Literal cases of single operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marblework.cases import quality as cases
from marblework.functions import text as X
from marblework.operators import joins, payloads, quality, rollup, rules, web
from marblework.plans import adhoc, layers
from marblework.sources import delimited


def values(spark, fn, xs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_italian_numbers(spark):
    assert values(spark, X.normalize_italian_number, ["1234", "1.234,56", "1234,56", "12.345.678", None, "abc", ""]) == [1234.0, 1234.56, 1234.56, 12345678.0, None, None, None]
    assert values(spark, X.normalize_italian_integer, ["1234", "1.234", "5.432,10", "5.432,90", None]) == [1234, 1234, 5432, 5433, None]


def test_casts(spark):
    assert values(spark, X.cast_int, ["5432.50", "-2.5", "x", "99999999999", " 7 "]) == [5433, -3, None, None, 7]
    assert values(spark, X.cast_double, ["1d", "1f", "1e3", ".5", "x"]) == [None, None, 1000.0, 0.5, None]
    assert values(spark, X.normalize_string, ["  a ", "", "  ", None]) == ["a", None, None, None]
    assert values(spark, lambda c: X.decode_flag(c, "SI"), ["SI", " SI ", "si", None]) == [True, True, False, False]


def test_normalize_number(spark):
    assert values(spark, X.normalize_number, ["1.234,56", "5849,00", "***", "-", "N.D.", ",", '"12"', "a1", "-3,5"]) == ["1234.56", "5849", None, None, None, None, "12", None, "-3.5"]


def test_decode_bytes(spark):
    raw = ["città".encode(), b"\xef\xbb\xbf" + "x".encode(), "perché €".encode("cp1252")]
    assert values(spark, X.decode_bytes, [bytearray(r) for r in raw], "binary") == ["città", "x", "perché €"]


def test_years_and_levels(spark):
    got = values(spark, X.years_in, ["dati_2015-2023.csv", "202122", "20142025", "n. 5", "1999"])
    assert [tuple(r) for r in got] == [(2015, 2023), (2021, 2022), (2014, 2025), (None, None), (1999, 1999)]
    assert values(spark, X.granularity, ["popolazione nei comuni", "dati provinciali", "Lazio", "x"]) == ["comune", "provincia", "regione", "non_determinato"]


def test_rules(spark):
    df = spark.createDataFrame([(2022, "A", 1.0), (2022, "A", float("nan")), (2023, None, 120.0)], "anno int, comune string, pct_rd double")
    found = {(r["rule"], r["column"]): r["bad_rows"] for r in rules.evaluate(df, rules.Rules(primary_key=["anno", "comune"], ranges={"pct_rd": (0, 100)}, not_null=["comune"], max_null_pct={"comune": 50.0})).collect()}
    assert found[("primary_key", "anno,comune")] == 1 and found[("range", "pct_rd")] == 2
    assert found[("not_null", "comune")] == 1 and found[("max_null_pct", "comune")] == 0
    report = rules.report(rules.evaluate(df, rules.Rules(not_null=["comune"], min_rows=5))).first()
    assert (report["passed"], report["errors"], report["score"]) == (False, 2, 60)


def test_hierarchy(spark):
    df = spark.createDataFrame([("Roma", "Lazio", 100, 50.5), ("Roma", "Lazio", 120, 55.0), ("Milano", "Lombardia", 200, 75.2), ("Milano", "Lombardia", 180, 70.0), ("Napoli", "Campania", 150, 60.0)], "comune string, regione string, valore int, costo double").withColumn("costo", F.col("costo").cast("decimal(8,1)"))
    both = rollup.rollup(df, {"comune": ["comune"], "regione": ["regione"]})
    assert {r["comune"]: r["valore"] for r in both["comune"].collect()} == {"Roma": 220, "Milano": 380, "Napoli": 150}
    assert sum(t.count() for t in both.values()) == 6 and "costo" in both["comune"].columns
    assert {r["record_count"] for r in rollup.level(df.select("comune"), ["comune"]).collect()} == {1, 2}


def test_top_values(spark):
    df = spark.createDataFrame([("Lombardia",)] * 3 + [("Lazio",), (None,)], "regione string")
    one = rollup.top_values(df, ["regione"], 1).first()
    assert (one["value"], one["count"], one["pct"], one["truncated"]) == ("Lombardia", 3, 60.0, True)
    assert not rollup.top_values(df, ["regione"], 2).first()["truncated"]


def test_sdmx_index_out_of_range(spark):
    said = '{"dataSets":[{"series":{"0":{"observations":{"3":[1]}}}}],"structure":{"dimensions":{"series":[{"id":"A","values":[{"id":"a","name":"x"}]}],"observation":[{"id":"T","values":[]}]}}}'
    with pytest.raises(Exception, match="index out of range"):
        payloads.sdmx_rows(spark.createDataFrame([(said,)], "payload string")).collect()


def test_sparql_empty_is_an_error(spark):
    with pytest.raises(Exception, match="empty result"):
        payloads.sparql_rows(spark.createDataFrame([('{"head":{"vars":["a"]},"results":{"bindings":[]}}',)], "payload string"), ["a"]).collect()


def test_links(spark):
    html = '<a href="dati/REG_tipo_reddito_2025.csv" title="R">x</a><a href="/b.XLSX">y</a><a href="#">z</a><a href="mailto:a@b.csv">m</a><a href="c.pdf">p</a><area href="//o.it/d.geojson?x=1"><a href="dati/REG_tipo_reddito_2025.csv">again</a>'
    got = web.data_links(spark.createDataFrame([("http://x.it/p/q.html", html)], "url string, html string")).orderBy("pos").collect()
    assert [(r["link"], r["format"]) for r in got] == [("http://x.it/p/dati/REG_tipo_reddito_2025.csv", "CSV"), ("http://x.it/b.XLSX", "XLSX"), ("http://o.it/d.geojson?x=1", "GEOJSON")]
    assert (got[0]["prefix"], got[0]["years"], got[0]["title"]) == ("REG", [2025], "R")


def test_ragged_files(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("a;b\n1;2;EXTRA\n3;4\n")
    (tmp_path / "short.csv").write_text("a;b;c\n1\n2;3\n4;5;6\n")
    (tmp_path / "trail.csv").write_text("a;b\n1;2;\n3;4;\n")
    at = lambda n: [f"file://{tmp_path}/{n}"]
    assert [tuple(r) for r in delimited.read_padded(spark, at("short.csv"), ["a", "b", "c"], {"sep": ";"}).collect()] == [("1", "", ""), ("2", "3", ""), ("4", "5", "6")]
    with pytest.raises(Exception, match="too many fields"):
        delimited.read_padded(spark, at("wide.csv"), ["a", "b"], {"sep": ";"}).collect()
    columns = {"columns": {"a": "INTEGER", "b": "INTEGER"}, "sep": ";"}
    assert [tuple(r) for r in delimited.read_csv(spark, at("trail.csv"), columns, "strict").collect()] == [(1, 2), (3, 4)]
    assert [tuple(r) for r in delimited.read_csv(spark, at("wide.csv"), columns, "fallback").collect()] == [(3, 4)]
    with pytest.raises(Exception, match="does not fit"):
        delimited.read_csv(spark, at("wide.csv"), columns, "strict").collect()
    (tmp_path / "cp.csv").write_bytes("nome;data\nperché €;02/01/2023\n".encode("cp1252"))
    got = delimited.read_csv(spark, at("cp.csv"), {"columns": {"nome": "VARCHAR", "data": "DATE"}, "sep": ";", "encoding": "cp1252", "dateformat": "dd/MM/yyyy"}).first()
    assert got["nome"] == "perché €" and got["data"].isoformat() == "2023-01-02"


def test_titles_and_blocks(spark, tmp_path):
    """Title lines go once for each file, however the file is cut into splits."""
    for f in "ab":
        (tmp_path / f"{f}.csv").write_text("Titolo\n\nid;v\n" + "".join(f"{f}{i};{i},5\n" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = delimited.read_csv(spark, [f"file://{tmp_path}"], {"sep": ";", "skip": 2, "decimal": ","})
            assert got.dtypes == [("id", "string"), ("v", "double")]
            assert sorted(tuple(r) for r in got.collect()) == sorted((f"{f}{i}", i + 0.5) for f in "ab" for i in range(500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_options_choose_the_mode(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n1;2\n3\n4;5;6\n")
    at, columns = [f"file://{tmp_path}/x.csv"], {"columns": {"a": "INTEGER", "b": "INTEGER"}, "sep": ";", "parallel": False}
    assert [tuple(r) for r in delimited.read_csv(spark, at, columns | {"null_padding": True}).collect()] == [(1, 2), (3, None)]
    with pytest.raises(Exception, match="does not fit"):
        delimited.read_csv(spark, at, columns | {"strict_mode": True}).collect()
    with pytest.raises(ValueError, match="unknown"):
        delimited.read_csv(spark, at, {"sepp": ";"})
    assert delimited.read_csv(spark, at, {"sep": ";", "auto_detect": False}).dtypes == [("a", "string"), ("b", "string")]


def test_cp1252_needs_no_setting(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("città €;n\nperché – ok;1\n".encode("cp1252"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    try:
        got = delimited.read_csv(spark, [f"file://{tmp_path}/x.csv"], {"sep": ";", "encoding": "win1252"})
        assert got.columns == ["città €", "n"] and tuple(got.first()) == ("perché – ok", 1)
        raw = [bytearray("perché €".encode("cp1252")), bytearray(b"caf\xe9 \x81"), bytearray("è".encode())]
        assert values(spark, X.decode_bytes, raw, "binary") == ["perché €", "café \x81", "è"]
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", before)


def test_aligned_files_are_read_by_header(spark, tmp_path):
    for name, text in {"a": "x,y\n1,2\n", "b": "y,x\n3,4\n", "c": "x,y\n5,6\n", "d": "x,z\n7,8\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    at = [f"file://{tmp_path}/{n}.csv" for n in "abcd"]
    assert len(delimited.by_header(spark, at, {})) == 3
    assert sorted(tuple(r) for r in delimited.read_aligned(spark, at, ["x", "y"]).collect()) == [("1", "2"), ("4", "3"), ("5", "6"), ("7", "")]
    assert delimited.union_by_header(spark, at).columns == ["x", "y", "z"]


def test_guard(spark):
    df = spark.range(3).toDF("k")
    assert adhoc.guarded(spark, "SELECT sum(k) AS s FROM t -- drop\n", {"t": df}).first()["s"] == 3
    df.createOrReplaceTempView("u")
    bad = [
        "DELETE FROM t",
        "SELECT * FROM u",
        "SELECT 1; DROP TABLE t",
        "SELECT * FROM csv.`/etc/passwd`",
        "SELECT * FROM t, u",
        "SELECT k FROM t UNION ALL TABLE u",
        "SELECT (SELECT max(k) FROM u) FROM t",
        "SELECT * FROM t WHERE EXISTS (WITH u AS (SELECT 1) SELECT * FROM u) AND k IN (SELECT k FROM u)",
        "SELECT ' FROM t ' FROM \n u",
        "SELECT * FROM t JOIN LATERAL (SELECT * FROM u)",
        "SELECT nonsense FROM FROM",
        "SELECT * FROM t -- '\n , u -- '",
        "SELECT r'\\' AS a, * FROM t, u WHERE '' = ''",
        "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    ]
    for sql in bad:
        with pytest.raises(ValueError):
            adhoc.guarded(spark, sql, {"t": df})
    assert spark.table("u").count() == 3
    for good in ("SELECT count(*) AS s FROM t a, t b", "WITH x AS (SELECT k FROM t), y AS (SELECT k FROM x) SELECT count(*) * 3 AS s FROM y", "SELECT s FROM (SELECT k * 3 + 3 AS s FROM t WHERE k IN (SELECT max(k) FROM T)) WHERE 'UnresolvedRelation [z]' <> ''"):
        assert adhoc.guarded(spark, good, {"t": df}).first()["s"] == 9
    assert "t" not in {x.name for x in spark.catalog.listTables()}
    said = adhoc.dry_run(spark, {"t": df}, "SELECT k FROM t WHERE k > 1")
    assert said["ok"] and "Filter" in said["plan"] and not adhoc.dry_run(spark, {"t": df}, "SELECT k FROM u")["ok"]
    with pytest.raises(ValueError, match="unresolved"):
        layers.run_sql(spark, "SELECT :year FROM {t}", {"t": df})


def test_layers_by_mode_and_year(spark):
    frames = {"raw": {(2022, "a"): spark.createDataFrame([(1, "1,5")], "n long, x string")}, "mart": {(2022, "b"): spark.range(2), (2023, "b"): spark.range(5), (2023, "a"): spark.range(9)}}
    assert adhoc.ask(spark, frames, "mart", "preview", limit=3).count() == 3
    assert adhoc.ask(spark, frames, "mart", "sql", 2022, sql="SELECT count(*) AS c FROM data").first()["c"] == 2
    assert adhoc.ask(spark, frames, "mart", "sql", table="b", sql="SELECT count(*) AS c FROM data").first()["c"] == 5
    assert [r["name"] for r in adhoc.ask(spark, frames, "raw").collect()] == ["n", "x"]
    assert adhoc.ask(spark, frames, "raw", "profile").count() == 1
    for wrong in ({"layer": "gold"}, {"mode": "x"}, {"layer": "mart", "mode": "profile"}, {"layer": "mart", "mode": "sql"}, {"layer": "mart", "year": 1999}):
        with pytest.raises(ValueError):
            adhoc.ask(spark, frames, **wrong)


def test_union_needs_all_years(spark):
    with pytest.raises(ValueError, match="2024"):
        joins.union_years({2023: spark.range(1)}, [2023, 2024])


def test_ontologies_take_the_first_part():
    assert quality.ontologies(["Codice Comune", "x", "importo"]) == {"Codice Comune": ["CLV", "ISTAT"], "importo": ["PC (PublicContract)", "QB (DataCube)"]}


def test_quality_without_headers_and_with_case(spark):
    raw = spark.createDataFrame([(1, "x")], "n long, line string")
    got = {r["id"]: r["status"] for r in quality.checks(raw, spark.createDataFrame([(1,)], "n long")).collect()}
    assert got == {"S1": "pass", "S2": "warn", "S3": "fail"}
    cells = spark.createDataFrame([(1, "1", "2")], "n long, c0 string, c1 string")
    status = lambda headers: {r["id"]: r["status"] for r in quality.checks(raw, cells, headers=headers).collect()}["S4"]
    assert (status(["Id", "id"]), status(["id", "id"])) == ("pass", "fail")


def test_quality_flags_need_their_severity(spark):
    found = spark.createDataFrame([("C2", "warn"), ("O3", "warn"), ("S4", "warn"), ("O4", "warn"), ("S8", "fail")], "id string, status string")
    assert quality.flags(found).first()["flags"] == ["column_naming", "encoding_issues"]


def test_quality_lines_are_whole_texts(spark, tmp_path):
    long = "word " * 20
    texts = [(0, f"first {long}\n\n# in the middle\nend"), (2, f"{long}\ufffd"), (1500, f"{long}caff\u00c3\u00a8 \x02\n{long}\n# in the tail"), (1501, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    lines = cases._lines(spark, str(tmp_path)).cache()
    want = "\n".join(t or "" for _, t in texts).split("\n")
    assert [tuple(r) for r in lines.orderBy("n").collect()] == list(enumerate(want, 1))
    got = quality.line_stats(lines).first()
    assert (got["unreadable"], got["mojibake"], got["control"], got["tail_comment"], got["filled"], got["bytes"]) == (1, 1, 1, True, 7, len("\n".join(want).encode()) + 1)


@pytest.mark.parametrize(
    ("lines", "s2", "s6"),
    [
        (["a;b;c", "1;2;3", "1;2", "1;2;3;4"], "pass", "fail"),
        (["a;b;c", "1;2;3", "", ";", '"x;y ""z""";2,5;"3"', '1;5" wide;3" high'], "pass", "pass"),
        (["a", "1", "2"], "warn", "pass"),
        (["a,b", "1,2", "1,2,3"], "pass", "fail"),
    ],
)
def test_quality_reads_the_separator_and_ragged_rows(spark, lines, s2, s6):
    raw = spark.createDataFrame(list(enumerate(lines, 1)), "n long, line string")
    cells = spark.createDataFrame([(1, "1", "2")], "n long, a string, b string")
    found = quality.checks(raw, cells).cache()
    got = {r["id"]: r["status"] for r in found.collect()}
    assert (got["S2"], got["S6"], quality.score(found).first()["critical"]) == (s2, s6, s6 == "fail")
