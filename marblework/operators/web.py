"""Links and signatures in landed web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marblework.functions import links as L

#: File extensions of data.
DATA_EXTENSIONS = (".csv", ".json", ".xlsx", ".xls", ".ods", ".zip", ".xml", ".parquet", ".geojson")
#: Texts that only pages of one portal software hold.
CKAN_SIGNATURES = ("/api/3/action/", "ckan-", "data-module=\"ckan", "CKAN")
#: Links that lead to no page.
_NO_PAGE = r"(?i)^(#|mailto:|tel:|javascript:)"


def tags(pages: DataFrame, names: tuple[str, ...] = ("a", "area"), url: str = "url", html: str = "html", by: tuple[str, ...] = ()) -> DataFrame:
    """(page, pos, found) after the columns of ``by``: the attributes of each page's tags of these names, in order."""
    each = pages.select(*by, F.col(url).alias("page"), F.posexplode(L.start_tags(F.coalesce(html, F.lit("")), names)).alias("pos", "tag"))
    return each.select(*by, "page", "pos", L.attributes(F.col("tag")).alias("found"))


def href(found: Column) -> Column:
    """Where a tag leads, outer white space cut; empty if nowhere."""
    plain, other = (L.attribute(found, n) for n in ("href", "xlink:href"))
    cut = F.regexp_replace(F.when(plain != "", plain).otherwise(other), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return F.when(cut.rlike(_NO_PAGE), "").otherwise(cut)


def is_data_link(url: Column, extensions=DATA_EXTENSIONS) -> Column:
    """Whether a URL's path, or the URL up to closing slashes, ends with one of the extensions."""
    any_of = "|".join(e.lstrip(".") for e in extensions)
    return F.lower(url).rlike(rf"(?s)^[^?]*\.({any_of})(\?|\z)|\.({any_of})/*\z")


def link_format(url: Column, extensions=DATA_EXTENSIONS) -> Column:
    """The upper-case extension of a data file's URL; null for others."""
    path = F.lower(F.split(url, "\\?")[0])
    whole = F.regexp_replace(F.lower(url), "/+$", "")
    out = None
    for e in sorted(extensions, key=lambda e: (-len(e), e)):
        hit = path.endswith(e) | whole.endswith(e)
        out = F.when(hit, e.lstrip(".").upper()) if out is None else out.when(hit, e.lstrip(".").upper())
    return out


def filename(url: Column) -> Column:
    """The decoded last part of the path without its extension."""
    name = F.url_decode(F.replace(F.regexp_extract(F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*", ""), r"[?#].*$", ""), r"([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def prefix(name: Column) -> Column:
    """What stands before an underscore, else leading capitals and digits, else six characters."""
    caps = F.regexp_extract(name, r"^([A-Z][A-Z0-9]{1,7})", 1)
    return F.when(name.contains("_"), F.split(name, "_")[0]).when(caps != "", caps).otherwise(F.substring(name, 1, 6))


def years(name: Column) -> Column:
    """The years 2000 to 2029 in a name, in order."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(20[012]\d)"), 1), lambda y: y.cast("int"))


def data_links(pages: DataFrame, extensions=DATA_EXTENSIONS, url: str = "url", html: str = "html", by: tuple[str, ...] = ()) -> DataFrame:
    """(page, pos, link, format, title, filename, prefix, years): links to data files, the first of each URL of a page.

    Pages of one URL count as one page unless they differ in the columns of ``by``, which come first in the result.
    """
    title = F.trim(F.coalesce(F.nullif(L.attribute(F.col("found"), "aria-label"), F.lit("")), L.attribute(F.col("found"), "title")))
    found = tags(pages, ("a", "area"), url, html, by).select(*by, "page", "pos", F.explode(F.array(href(F.col("found")))).alias("href"), title.alias("title")).filter("href <> ''")
    # generated, so that the link is a column of its own and later expressions do not repeat how it is made
    links = found.select(*by, "page", "pos", "title", F.explode(F.array(L.resolved(F.col("page"), F.col("href")))).alias("link")).filter(is_data_link(F.col("link"), extensions))
    first = links.groupBy(*by, "page", "link").agg(F.min(F.struct("pos", "title")).alias("x")).select(*by, "page", "link", "x.*")
    with_name = first.select("*", link_format(F.col("link"), extensions).alias("format"), filename(F.col("link")).alias("filename"))
    return with_name.select(*by, "page", "pos", "link", "format", "title", "filename", prefix(F.col("filename")).alias("prefix"), years(F.col("filename")).alias("years"))


def link_groups(links: DataFrame) -> DataFrame:
    """(prefix, count, years, formats, title) of links with a common prefix; the most frequent first."""
    return (
        links.groupBy("prefix")
        .agg(F.count("*").alias("count"), F.collect_set("years").alias("ys"), F.sort_array(F.collect_set("format")).alias("formats"), F.min_by("title", F.struct("page", "pos")).alias("title"))
        .select("prefix", "count", F.array_sort(F.array_distinct(F.flatten("ys"))).alias("years"), "formats", "title")
        .orderBy(F.desc("count"), "prefix")
    )


def feeds(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page, feed, title): RSS and Atom links of each page."""
    each = tags(pages, ("link",), url, html)
    of = lambda n: L.attribute(F.col("found"), n)
    alternate = each.filter(F.lower(of("rel")).startswith("alternate") & F.lower(of("type")).rlike(r"application/(rss|atom)\+xml"))
    return alternate.select("page", L.resolved(F.col("page"), of("href")).alias("feed"), of("title").alias("title"))


def internal_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page, internal_links): a-links of the page's own host."""
    host = lambda c: F.lower(F.regexp_extract(c, r"^[a-zA-Z][\w+.-]*://(?:[^@/?#]*@)?([^/:?#]*)", 1))
    hrefs = F.filter(F.transform(L.start_tags(F.coalesce(html, F.lit("")), ("a",)), lambda t: href(L.attributes(t))), lambda h: h != "")
    own = F.filter(hrefs, lambda h: host(L.resolved(F.col(url), h)) == host(F.col(url)))
    return pages.select(F.col(url).alias("page"), F.size(own).alias("internal_links"))


def has_jsonapi(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit("jsonapi"))


def has_ckan(html: Column) -> Column:
    out = F.lit(False)
    for s in CKAN_SIGNATURES:
        out = out | html.contains(s)
    return out


def ckan_id(url: Column, html: Column) -> Column:
    """The dataset's id from the query, the path, or an API link in the page; null without one."""
    got = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.coalesce(got(url, r"(?i)[?&]id=([a-f0-9-]{36,})"), got(url, r"(?i)/dataset/([^/?#]+)"), got(html, r"""/api/3/action/package_show\?id=([^"'<>\s&]+)"""))


def endpoint_kind(url: Column, content_type: Column | None = None) -> Column:
    """sdmx, sparql or null."""
    low = F.lower(url)
    sparql = low.contains("/sparql")
    if content_type is not None:
        sparql = sparql | F.coalesce(F.lower(content_type).contains("sparql"), F.lit(False))
    return F.when(low.contains("sdmx") | low.contains("/dataflow/") | low.contains("?flow="), "sdmx").when(sparql, "sparql")
