"""Tags, attributes and URLs of web pages as Columns; null gives null.

``start_tags`` and ``attributes`` scan HTML, ``unescaped`` decodes character
references, ``resolved`` joins a link to its page's URL as RFC 3986 says, with
dot segments removed by a fold over the segments of the path.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from marblework.functions import text as X

#: Schemes whose relative links are resolved, and those whose last path segment may have ``;`` parameters.
HIERARCHICAL = ("ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
WITH_PARAMETERS = ("ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")
_TAG_END = r"""(?=[\s/>])(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)?))?"""
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*)[;=]?|[^&]+|&"
_NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|(<(script|style)\b[^>]*>).*?(?:</\2\s*>|\z)"


def start_tags(page: Column, names: tuple[str, ...]) -> Column:
    """The start tags of these names in order; none from comments, scripts and styles."""
    shown = F.regexp_replace(page, _NOT_MARKUP, " ")
    return F.regexp_extract_all(shown, F.lit(f"(?i)<(?:{'|'.join(names)}){_TAG_END}"), F.lit(0))


def attributes(tag: Column) -> Column:
    """The attributes of a start tag in order, as structs of a lower-case ``name`` and a decoded ``value`` (empty if it has none)."""
    inside = F.regexp_extract(tag, r"(?s)^<[^\s/>]+(.*)>\z", 1)
    each = lambda i: F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(i))
    return F.transform(F.arrays_zip(each(1).alias("n"), each(2).alias("a"), each(3).alias("b"), each(4).alias("c")), lambda x: F.struct(F.lower(x["n"]).alias("name"), unescaped(F.concat(x["a"], x["b"], x["c"])).alias("value")))


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def attribute(found: Column, name: str) -> Column:
    """The value of the last attribute of this name; empty without one."""
    return F.coalesce(F.try_element_at(F.filter(found, lambda x: x["name"] == name), F.lit(-1))["value"], F.lit(""))


def named_references() -> dict[str, str]:
    """The named character references of HTML, as Python's standard library has them."""
    return dict(html.entities.html5)


def _character(n: Column) -> Column:
    """The character of a numeric reference: what browsers show, which reads 128 to 159 as CP1252."""
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    surrogate = (n >= 0xD800) & (n <= 0xDFFF)
    nothing = (n < 9) | (n == 11) | (n > 13) & (n < 32) | (n == 127) | (n >= 0xFDD0) & (n <= 0xFDEF) | (n % 65536 >= 0xFFFE)
    return F.when((n == 0) | surrogate | (n > 0x10FFFF) | n.isNull(), "�").when((n < 160) & (n > 127), X.latin1_to_cp1252(plain)).when(nothing, "").otherwise(plain)


def unescaped(c: Column) -> Column:
    """Text with its character references decoded; a name counts only if it is whole and no ``=`` follows, as in attributes."""
    table = F.from_json(F.lit(json.dumps(named_references())), "map<string,string>")

    def number(p: Column) -> Column:
        """The code of a numeric reference; null beyond eight digits, which are out of range anyway."""
        decimal = F.ltrim(F.regexp_extract(p, r"^&#([0-9]+)", 1), F.lit("0"))
        hexes = F.ltrim(F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
        return F.when((F.length(decimal) <= 8) & (F.length(hexes) <= 8), F.when(p.rlike("^&#[0-9]"), F.concat(F.lit("0"), decimal).cast("bigint")).otherwise(F.conv(F.concat(F.lit("0"), hexes), 16, 10).cast("bigint")))

    def piece(p: Column) -> Column:
        numeric = F.concat(let(number(p), _character), F.when(p.endswith("="), "=").otherwise(""))
        return F.when(~p.startswith("&"), p).when(p.rlike("^&#([0-9]|[xX][0-9a-fA-F])"), numeric).otherwise(F.coalesce(F.try_element_at(table, F.substring(p, F.lit(2), F.length(p))), p))

    decoded = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), piece), "")
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def url_parts(c: Column) -> Column:
    """scheme (lower case), host (with user and port), path, params, query, fragment; missing ones are empty."""
    clean = F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    pattern = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
    part = lambda i: F.regexp_extract(clean, pattern, i)
    return F.struct(F.lower(part(1)).alias("scheme"), part(2).alias("host"), part(3).alias("path"), part(4).alias("query"), part(5).alias("fragment"))


def without_dots(segments: Column) -> Column:
    """Path segments after a fold that drops ``.`` and takes one segment back for each ``..``."""
    none = F.slice(segments, F.lit(1), F.lit(0))
    walked = F.aggregate(segments, none, lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)


def _whole(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    place = F.when((host != "") | scheme.isin(*HIERARCHICAL) & ((path == "") | path.startswith("/")), F.concat(F.lit("//"), host, rooted)).otherwise(path)
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), place, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))


def resolved(base: Column, link: Column) -> Column:
    """The absolute URL of a link on the page ``base``."""

    def within(x: Column) -> Column:
        b, u, params = x["b"], x["u"], x["params"]
        path = F.substring(u["path"], F.lit(1), F.length(u["path"]) - F.length(params))
        plain = F.when(b["scheme"].isin(*WITH_PARAMETERS), F.regexp_replace(b["path"], r"(?s)^((?:.*/)?[^;/]*);[^/]*$", "$1")).otherwise(b["path"])
        folder = let(F.split(plain, "/"), lambda kept: F.when(F.element_at(kept, -1) != "", F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept))
        # a relative link leaves no empty segments between the first and the last
        below = let(F.concat(folder, F.split(path, "/")), lambda all_: F.filter(all_, lambda s, i: (i == 0) | (i == F.size(all_) - 1) | (s != "")))
        segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(below)
        walked = let(segments, lambda s: F.array_join(without_dots(s), "/"))
        new_path = F.concat(F.coalesce(F.nullif(walked, F.lit("")), F.lit("/")), F.when(params == ";", "").otherwise(params))
        nothing = (path == "") & (F.length(params) < 2)
        return (
            F.when((u["scheme"] != "") & (u["scheme"] != b["scheme"]) | ~b["scheme"].isin(*HIERARCHICAL), x["link"])
            .when(u["host"] != "", _whole(b["scheme"], u["host"], F.regexp_replace(u["path"], r";$", ""), u["query"], u["fragment"]))
            .when(nothing, _whole(b["scheme"], b["host"], b["path"], F.when(u["query"] != "", u["query"]).otherwise(b["query"]), u["fragment"]))
            .otherwise(let(new_path, lambda p: _whole(b["scheme"], b["host"], p, u["query"], u["fragment"])))
        )

    # parameters belong to the last segment and are no part of its name
    params = lambda b, u: F.when(b["scheme"].isin(*WITH_PARAMETERS), F.regexp_extract(u["path"], r"(?s)^(?:.*/)?[^;/]*(;[^/]*)$", 1)).otherwise("")
    split = let(F.struct(url_parts(base).alias("b"), url_parts(link).alias("u"), link.alias("link")), lambda y: let(F.struct(y["b"].alias("b"), y["u"].alias("u"), y["link"].alias("link"), params(y["b"], y["u"]).alias("params")), within))
    return F.when(base == "", link).when(link == "", base).otherwise(split)

