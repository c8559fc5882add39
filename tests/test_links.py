"""Links of pages: joining as the standard library joins, tags and attributes as browsers read them."""

from __future__ import annotations

import random
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from marblework import registry
from marblework.functions import links as L
from marblework.operators import web

BASES = ["http://h.it/a/b/c.html?x=1#f", "http://h.it", "https://h.it/", "http://u@h.it:80/a//b/../c;p=1", "ftp://h/x/y/", "mailto:a@b", "HTTP://H.it/A/b;v=2?q", "http://h.it/a/b/;z", "http://h.it/?q=/a/b"]
LINKS = ["", "?f=x.csv", "#t", "//o.it/z/../q", "http:x.csv", "HTTP://o.it", "https://h.it/k?", "x.csv?", "y#", "  x.csv", "a\tb", "tel:1", "ftp:/k", "/", "//", "///k", "?", "..", "../", "./", ".", "/..", "/../x", "g;x=1/../y", "http://h.it//a/../b;", "ws://k/..", ";x", ";"]
SEGMENTS = ["..", ".", "a", "x.csv", "", "b;p=1", "%20", "c d", "é", "..;x", "a:b"]


def test_links_join_as_the_library_joins(spark):
    rng, found = random.Random(4), [*LINKS]
    for _ in range(400):
        link = "/".join(rng.choice(SEGMENTS) for _ in range(rng.randint(1, 6)))
        found.append(rng.choice(["", "", "/"]) + link + rng.choice(["", "", "?q", "?a=../b", "?", "?x?y"]) + rng.choice(["", "", "#f", "#", "#a#b?c"]))
    df = spark.createDataFrame([(b, x) for b in BASES for x in found], "b string, x string")
    for r in df.select("b", "x", L.resolved(F.col("b"), F.col("x")).alias("got")).collect():
        assert r["got"] == urljoin(r["b"], r["x"]), (r["b"], r["x"])


def attributes(spark, tags):
    df = spark.createDataFrame(list(enumerate(tags)), "i int, t string")
    rows = df.select("i", F.transform(L.start_tags(F.col("t"), ("a", "area")), L.attributes).alias("x")).orderBy("i").collect()
    return [[[tuple(x) for x in tag] for tag in r["x"]] for r in rows]


def test_attributes(spark):
    want = {
        "<A HREF=x.csv title=a>": [("href", "x.csv"), ("title", "a")],
        "<a href='q>r' href=z>": [("href", "q>r"), ("href", "z")],
        '<a\nhref = "k"\n/>': [("href", "k")],
        "<a href>": [("href", "")],
        "<a href=a/b/>": [("href", "a/b/")],
        "<a href=\"a\"title='b'>": [("href", "a"), ("title", "b")],
        "<a data-href=no href=yes>": [("data-href", "no"), ("href", "yes")],
        '<area href="a&amp;b=&#x41;&#66;&copy;&copy=1&lt&nope;&eacute;">': [("href", "a&b=AB©&copy=1<&nope;é")],
        '<a href="&#128;&#0;&#xD800;&#99999999999;&#11;&#x;&#1114112;">': [("href", "€���&#x;�")],
    }
    assert attributes(spark, [*want]) == [[v] for v in want.values()]
    assert attributes(spark, ["<abbr href=x><!-- <a href=y> --><script>'<a href=z>'</script><STYLE><a></style >", "<a href='open", "", '<a href="' + "x" * 300_000 + '">']) == [[], [], [], [[("href", "x" * 300_000)]]]


def test_data_links_of_a_page(spark):
    page = '<a href=" ../../x.csv ">1</a><a href=?f=x.csv title="n&amp;m">2</a><area href="x/../y.csv"><a xlink:href="z.zip" href=""><a href="MAILTO:a@b.csv"><!-- <a href="no.csv"> --><a href="y.csv">again</a>'
    got = web.data_links(spark.createDataFrame([("http://h.it/a/b/p.html", page), (None, page), ("http://h.it", None)], "url string, html string")).filter("page IS NOT NULL").orderBy("pos").collect()
    assert [(r["link"], r["title"]) for r in got] == [("http://h.it/x.csv", ""), ("http://h.it/a/b/p.html?f=x.csv", "n&m"), ("http://h.it/a/b/y.csv", ""), ("http://h.it/a/b/z.zip", "")]


@pytest.mark.parametrize("name", ["web_link_fields", "web_link_groups", "web_links"])
def test_pages_of_one_url_in_several_forms(name, spark, tmp_path):
    """Query strings cut, pages 0, 2, 3, 8 and 11 have one URL: 0 and 8 are of one form, 3 and 11 of another, 2 of a third."""
    pages = [(i, f"http://h.it/en/7{end}", html) for i, end, html in [(0, "?a=1", '<a href="/x"><a href="/x">'), (2, "#top", '<a href="/x">'), (3, "", '<a href="/x">'), (8, "/", '<a href="/x"><a href="/y">'), (11, "?a=2", '<a href="/x">'), (9, ".html", '<a href="/x">')]]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = duckdb.sql(registry.oracle_sql()[name].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'"))
    got = registry.queries()[name](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(list, got.collect())) == sorted(map(list, want.fetchall()))
