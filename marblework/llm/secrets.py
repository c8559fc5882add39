"""Secret scans: three base patterns, and assignments with propagated constants.

The base finds keyword assignments, access keys and long hexadecimal runs.  The
lexer reads source and configuration text around its operators:

* targets: names with dots, dashes or sigils, quoted keys, and subscripts, of
  which both the key and the name before it count; a type between name and ``=``
  is passed over;
* values: quoted, triple-quoted and multi-line literals, block scalars, bare
  words, names of constants, authorization schemes with their word, and
  expressions of these: joined by ``+``, ``.``, ``..`` or by standing side by
  side, in brackets and in calls, each argument for itself (what a look-up call
  asks for is a key and no value);
* elements ``<name>value</name>`` of XML;
* what stands for an assignment: ``+=``, ``?=`` and ``||=``, several targets at
  once, macros, options ``--name value``, setters, records and attributes of a
  ``name`` or ``key`` and a ``value``, calls whose first argument is the name, and
  lines of a name and a value without any sign.

Each pair of a target and a value is a definition.  A reference stands for all
definitions of its name in the same function or class, or else in the whole
text, wherever they stand, so a name that is assigned twice keeps both literals.
The sensitivity of names flows along references until nothing changes.  A
literal is scored by the most sensitive name that it reaches, and by the look of
the whole string that is put together there.  Spans are in code points, end
exclusive.

A bare word ends at white space, quotes and brackets.  One with more than
MOST_INSIDE operators is a list, as a query string is, and no value: in it a value
ends at the next operator, without the name there and the sign before it.
Brackets are followed MOST_DEPTH deep.  So the time to read a text grows with its
length, whatever it holds.

Null text is empty.  Texts are scanned whole.  Rows are independent: repeated
rows get equal results, ties cannot arise (spans are ordered by start and kind),
an empty table gives an empty one, and other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

from pyspark.sql import DataFrame

from marblework.llm.common import map_rows, replace_text

#: The base patterns, the length that a match must reach and the group that it is measured on.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
KINDS = [*BASE, "literal"]
#: Parts of names that make a target sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.7, "authorization": 0.8, "privatekey": 1.0,
    "accesskey": 1.0, "secretkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0, "clientsecret": 1.0, "dsn": 0.6,
}
#: Every sensitive part of a name holds one of these, whatever stands between its pieces.
HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "bearer", "auth", "dsn")
_JOINTS = str.maketrans("", "", "_-.$")
#: Literals that stand for a missing secret.
PLACEHOLDER = re.compile(r"(?i)change_?me|example|placeholder|your[_-]|dummy|redacted|<[^>]*>|\$\{|\{\{|x{4,}|\*{3,}|^(none|null|true|false|undefined)$")
#: The least product of a name's and a literal's score that makes a span.
LEAST_SCORE = 0.5

#: Operators in a bare word beyond which it is read as a list of assignments.
MOST_INSIDE = 8
#: Brackets within brackets that an expression is followed into.
MOST_DEPTH = 16

_OPERATOR = re.compile(r"=>|:=|(?:\+|\?\??|\|\|)=(?!=)|(?<![!=<>:+\-*/?|])=(?![=>])|:(?![:=/])")
_NAME_END = re.compile(r"[A-Za-z_$][\w$.\-]*\Z", re.A)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
#: Groups: what quotes or a reference hold; group 6 is the name after $.
_VALUE = re.compile(
    r"""[ \t]*(?:[rbufRBUF]{0,2}(?:\"""((?:[^\\]|\\[\s\S])*?)\"""|\'''((?:[^\\]|\\[\s\S])*?)\'''|"((?:[^"\\\n]|\\[\s\S])*)"|'((?:[^'\\\n]|\\[\s\S])*)')|`([^`]*)`"""
    r"""|\$\{?([A-Za-z_]\w*)\}?)""",
    re.A,
)
_BLANKS = re.compile(r"[ \t]*")
_BARE = re.compile(r"""[^\s"'`,;#(){}\[\]]+""")
#: A sign and a name at the end of one value of a list.
_NEXT_NAME = re.compile(r"[&?|][\w$.\-%]*\Z", re.A)
#: A quoted literal over several lines: no blank line in it, and nothing of a word after it.
_LINES = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\[\s\S]|\n(?![ \t]*\n))*)"|'((?:[^'\\\n]|\\[\s\S]|\n(?![ \t]*\n))*)')(?=[\s,;.+)\]}]|\Z)""")
_BLOCK = re.compile(r"[ \t]*(?:[!&]\S+[ \t]+)*[|>][+\-1-9]{0,2}[ \t]*(?:[ \t]#[^\n]*)?\r?\n")
_INDENT = re.compile(r"[ \t]*(?:-[ \t]+)*")
_TYPE_STRING = re.compile(r"""[ \t]*(?:"[^"\n]*"|'[^'\n]*')[ \t]*(?==(?![=>]))""")
#: A name or key before an operator that is a subscript: the name before the bracket.
_SUBSCRIPTED = re.compile(r"[A-Za-z_$][\w$.\-]*\Z", re.A)
#: What may open before a term: brackets and calls.  Group 1 is the call's name.
_OPEN = re.compile(r"[ \t]*(?:(?:new|await|return|not|&|\*)[ \t]+)*((?:[A-Za-z_$][\w$]*(?:\.|::|->))*[A-Za-z_$][\w$]*)?[ \t]*(\()[ \t\r\n]*", re.A)
_JOIN = re.compile(r"[ \t]*(?:\\\r?\n[ \t]*)?(?:(?:\+|\.\.?)(?!=)[ \t]*(?:\\?\r?\n[ \t]*)?)?")
_INSIDE = re.compile(r"[ \t\r\n]*(?:\+|\.\.?)?[ \t\r\n]*")
_CLOSE = re.compile(r"[ \t\r\n]*\)")
_COMMA = re.compile(r"[ \t\r\n]*,[ \t\r\n]*")
_KEYWORD = re.compile(r"[A-Za-z_$][\w$\-]*[ \t]*(?:=|:)(?!=)", re.A)
_QUOTE = re.compile(r"[rbufRBUF]{0,2}[\"'`]")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:\-]*)(?:[ \t][^<>]*)?>([^<>]{8,})</\1[ \t]*>", re.A)
_SCOPE = re.compile(r"^[ \t]*(?:(?:export|public|private|protected|static|async|final|pub)[ \t]+)*(?:def|function|func|fn|class|sub)\b", re.M)
#: Calls whose first argument is the key that they look up.
LOOKUPS = ("getenv", "get", "env", "fetch", "getproperty", "getparameter", "config", "var", "lookup", "setting", "input", "prompt", "getpass")
#: Schemes of authorization that stand before the secret word.
SCHEMES = ("bearer", "basic", "token", "digest", "apikey")
_IDENTIFIER = re.compile(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*\Z", re.A)
_NAME = r"[A-Za-z_$][\w$.\-]{0,200}"
#: Forms that stand for an assignment, up to where the value begins.  Group 1 is the name.
_FORMS = [
    re.compile(rf"^[ \t]*#[ \t]*define[ \t]+({_NAME})[ \t]+(?=\S)", re.M | re.A),
    re.compile(rf"(?<!\S)--?({_NAME})[ \t]+(?![\-\s])", re.A),
    re.compile(rf"\b(?:set|with|put)_?({_NAME})\([ \t]*(?=[\"'`\w$])", re.A),
    re.compile(rf"\b(?!(?i:get|getenv|env|fetch|lookup|input|prompt|getpass|has|contains)\b)\w{{1,60}}\([ \t\r\n]*[\"']({_NAME})[\"'][ \t\r\n]*,[ \t\r\n]*(?=[\"'`\w$])", re.A),
    re.compile(rf"\b(?:name|key|id)[\"']?[ \t]*[:=][ \t]*[\"']?({_NAME})[\"']?[ \t\r\n]*,?[ \t\r\n]*[\"']?(?:value|val|content|default)[\"']?[ \t]*[:=][ \t]*(?=\S)", re.A | re.I),
    re.compile(rf"^[ \t]*({_NAME})[ \t]+(?=[\"'][^\"'\n]*[\"'][ \t]*;?[ \t\r]*$)", re.M | re.A),
    re.compile(rf"^[ \t]*({_NAME})[ \t]+(?=[^\s=:]+[ \t\r]*$)", re.M | re.A),
]
#: A record with its value first; group 2 is the name.
_VALUE_FIRST = re.compile(rf"\b(?:value|val)[\"']?[ \t]*[:=][ \t]*[\"']([^\"'\n]+)[\"'][ \t\r\n]*,?[ \t\r\n]*[\"']?(?:name|key|id)[\"']?[ \t]*[:=][ \t]*[\"']?({_NAME})", re.A | re.I)
_TARGETS = re.compile(rf"(?:^|(?<=[;\n(]))[ \t]*\(?[ \t]*({_NAME}(?:[ \t]*,[ \t]*{_NAME})+)[ \t]*\)?[ \t]*(?=:?=(?![=>]))", re.M | re.A)
_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    for kind, (pattern, group, least) in BASE.items():
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return found


def name_score(name: str) -> float:
    """How sensitive a target name is: its parts, and its neighbouring parts joined."""
    parts = [p.lower() for p in _HUMP.findall(name)]
    joined = ["".join(parts[i : i + 2]) for i in range(len(parts) - 1)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + joined), default=0.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, mixture and entropy."""
    if len(value) < 8 or PLACEHOLDER.search(value):
        return 0.0
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * (1.0 if kinds >= 2 else 0.6)


def _name_before(text: str, at: int, colon: bool) -> tuple[str, int] | None:
    """The whole target that ends before an operator, and its start: a name, a quoted key, or a subscript as name and key."""
    while at and text[at - 1] in " \t":
        at -= 1
    if colon and at and text[at - 1] in "?!":  # optional or asserted
        at -= 1
    subscript = at and text[at - 1] == "]"
    at -= bool(subscript)
    quoted = at and text[at - 1] in "\"'"
    at -= bool(quoted)
    start = at
    while start and text[start - 1] in _NAME_CHARS:
        start -= 1
    name = _NAME_END.search(text[start:at])
    if not name:
        return None
    said, first = name[0], start + name.start()
    if subscript:
        before = first - bool(quoted)
        if before and text[before - 1] == "[":
            low = before - 1
            while low and text[low - 1] in _NAME_CHARS:
                low -= 1
            if base := _SUBSCRIPTED.search(text[low : before - 1]):
                return f"{base[0]}.{said}", low + base.start()
    return said, first


def _after_type(text: str, at: int) -> int:
    """The place after the ``=`` that ends a type annotation from ``at``, or -1.  A second colon ends the search."""
    quoted = _TYPE_STRING.match(text, at)
    if quoted:
        return quoted.end() + 1
    depth, i = 0, at
    while i < len(text):
        c = text[i]
        if text.startswith(("::", "->", "=>"), i):
            i += 2
            continue
        if c in "[<(":
            depth += 1
        elif c in "]>)":
            depth -= 1
        elif c == "=" and not depth:
            return i + 1 if text[at:i].strip() and not text.startswith("=", i + 1) else -1
        elif c in "\n:=;`#{}" or not depth and (c in ',"' or c == "'" and text[i - 1] not in "&<"):
            return -1
        if depth < 0:
            return -1
        i += 1
    return -1


def _block(text: str, at: int, name_start: int) -> tuple[int, int] | None:
    """The place of a block scalar: the lines under its key that are indented more."""
    head = _BLOCK.match(text, at)
    if not head:
        return None
    line = text.rfind("\n", 0, name_start) + 1
    least = _INDENT.match(text, line).end() - line
    start = end = -1
    i = head.end()
    while i < len(text):
        stop = text.find("\n", i)
        stop = len(text) if stop < 0 else stop
        said = text[i:stop]
        if said.strip():
            indent = len(said) - len(said.lstrip(" \t"))
            if indent <= least:
                break
            start = i + indent if start < 0 else start
            end = i + len(said.rstrip())
        i = stop + 1
    return (start, end) if start >= 0 else None


class _Bare:
    """Ends of the bare words of a text; the word around a place is looked for once."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.many = text, 0, 0, False
        self.operators = [m.start() for m in _OPERATOR.finditer(text)]

    def listed(self, at: int) -> tuple[int, int] | None:
        """(start, end) of the bare word at a place inside a list of assignments that has been looked at; no other."""
        return self.at(at) if self.many and self.start <= at < self.end and self.text[at] != "$" else None

    def at(self, at: int) -> tuple[int, int] | None:
        """(start, end) of the bare word that begins at a place."""
        if not self.start <= at < self.end:
            word = _BARE.match(self.text, at)
            if not word:
                return None
            self.start, self.end = word.span()
            self.many = bisect_left(self.operators, self.end) - bisect_left(self.operators, at) > MOST_INSIDE
        if not self.many:
            return at, self.end
        following = bisect_left(self.operators, at)
        end = min(self.end, self.operators[following]) if following < len(self.operators) else self.end
        if end < self.end and (tail := _NEXT_NAME.search(self.text, max(at, self.text.rfind("&", at, end), self.text.rfind("?", at, end), self.text.rfind("|", at, end)), end)):
            end = tail.start()
        return (at, end) if end > at else None


def _value_at(text: str, at: int, bare: _Bare) -> tuple[int, int, str | None, bool] | None:
    """(start, end, reference, quoted) of the value after an operator."""
    value = _VALUE.match(text, at)
    if value:
        group = value.lastindex
        if group == 4 and " " in value[4] and text[value.end() : value.end() + 1].isalnum():  # an apostrophe, as in don't
            return None
        return value.start(group), value.end(group), value[group] if group == 6 else None, group < 6
    if word := bare.at(_BLANKS.match(text, at).end()):
        return *word, text[slice(*word)] if _IDENTIFIER.match(text, *word) else None, False
    lines = _LINES.match(text, at)
    return lines and (lines.start(lines.lastindex), lines.end(lines.lastindex), None, True)


def _term(text: str, at: int, bare: _Bare) -> tuple[tuple, int, bool] | None:
    """((start, end, reference), where the term ends, quoted) of one literal, name or bare word."""
    got = _value_at(text, at, bare)
    if not got:
        return None
    start, end, reference, quoted = got
    after = end
    if quoted:
        after = end + (3 if text[end : end + 3] in ('"""', "'''") and text[start - 3 : start] == text[end : end + 3] else 1)
    elif reference and text[end : end + 1] == "}":
        after = end + 1
    return (start, end, reference), after, quoted


def _expression(text: str, at: int, bare: _Bare) -> tuple[list[list[tuple]], bool]:
    """The values of an expression, each a list of joined parts (start, end, reference), and whether any is quoted."""
    if (word := bare.listed(at)) and text[word[1] : word[1] + 1] not in ("(", '"', "'", "`"):
        return [[(*word, text[slice(*word)] if _IDENTIFIER.match(text, *word) else None)]], False
    depth, values, parts, any_quoted, skip = 0, [], [], False, False
    while True:
        while depth < MOST_DEPTH and (opened := _OPEN.match(text, at)):
            depth += 1
            at = opened.end()
            called = (opened[1] or "").replace("::", ".").replace("->", ".").rsplit(".", 1)[-1].lower()
            skip = called in LOOKUPS
            if parts:
                values.append(parts)
                parts = []
        if depth and _KEYWORD.match(text, at):  # an argument by name is a definition of its own
            break
        got = _term(text, at, bare)
        if not got:
            break
        (start, end, reference), at, quoted = got
        if not quoted and not values and not parts and end - start < 10 and text[start:end].lower() in SCHEMES and text[at : at + 1] == " " and (word := _term(text, at + 1, bare)):
            (start, end, reference), at, quoted = word
        parts.append((start, end, reference))
        any_quoted = any_quoted or quoted
        joined = (_INSIDE if depth else _JOIN).match(text, at)
        closed = False
        while depth and (close := _CLOSE.match(text, at)):
            depth, at, closed = depth - 1, close.end(), True
        comma = _COMMA.match(text, at) if depth else None
        if comma or closed:
            if not skip:
                values.append(parts)
            parts, skip = [], False
            if not comma:
                break
            at = comma.end()
            continue
        by_sign = joined[0].strip(" \t\r\n\\") != ""
        if not by_sign and not (quoted and _QUOTE.match(text, joined.end())):
            break
        at = joined.end()
    if parts:
        values.append(parts)
    return values, any_quoted


def _items(text: str, at: int, bare: _Bare) -> list[tuple]:
    """The parts of a list of values with commas between them, in a bracket or not."""
    opened = _OPEN.match(text, at)
    at, out = opened.end() if opened and not opened[1] else at, []
    while got := _term(text, at, bare):
        part, after, _ = got
        out.append(part)
        comma = _COMMA.match(text, after)
        if not comma:
            break
        at = comma.end()
    return out


def assignments(text: str) -> list[tuple[str, int, list[tuple]]]:
    """(target, its place, joined parts (start, end, reference)): a part is a literal's place or the name of a constant.

    A type between a name and ``=`` is passed over.
    """
    bare = _Bare(text)
    pairs = [(m[1], m.start(), [(m.start(2), m.end(2), None)]) for m in _ELEMENT.finditer(text)] if "</" in text else []
    for op in _OPERATOR.finditer(text):
        colon = op[0] == ":"
        name = _name_before(text, op.start(), colon)
        if not name:
            continue
        if colon:
            block = _block(text, op.end(), name[1])
            if block:
                pairs.append((*name, [(*block, None)]))
                continue
            typed = _after_type(text, op.end())
            if typed >= 0:
                values, quoted = _expression(text, typed, bare)
                pairs += [(*name, parts) for parts in values]
                if quoted:
                    continue
        pairs += [(*name, parts) for parts in _expression(text, op.end(), bare)[0]]
    for form in _FORMS:
        # a sign is missing here, so only sensitive names count
        pairs += [(m[1], m.start(1), parts) for m in form.finditer(text) if name_score(m[1]) for parts in _expression(text, m.end(), bare)[0][:1]]
    pairs += [(m[2], m.start(2), [(m.start(1), m.end(1), None)]) for m in _VALUE_FIRST.finditer(text) if name_score(m[2])]
    for m in _TARGETS.finditer(text):
        names = re.split(r"[ \t]*,[ \t]*", m[1])
        parts = _items(text, m.end() + (2 if text[m.end()] == ":" else 1), bare)
        pairs += [(n, m.start(1), [x]) for n, x in zip(names, parts, strict=False)]
    return pairs


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly or through constants."""
    plain = text.lower().translate(_JOINTS)
    if not any(h in plain for h in HINTS):
        return []
    found = assignments(text)
    fences = [m.start() for m in _SCOPE.finditer(text)]
    group = [(name, bisect_right(fences, at)) for name, at, _ in found]
    last: dict[tuple, int] = {g: i for i, g in enumerate(group)}
    last |= {(name, None): i for i, (name, _) in enumerate(group)}
    need = {g: name_score(g[0]) for g in dict.fromkeys(group)}
    if not any(need.values()):
        return []

    def meant(i: int, reference: str | None) -> tuple | None:
        """The definitions that a reference stands for: those of its scope, else all of its name."""
        near = (reference, group[i][1])
        return near if near in last else (reference, None) if (reference, None) in last else None

    leads: dict[tuple, set[tuple]] = defaultdict(set)
    for name, at in need:
        leads[name, None].add((name, at))
    for i, (_, _, parts) in enumerate(found):
        leads[group[i]] |= {g for _, _, reference in parts if reference and (g := meant(i, reference))}
    # sensitivity flows from targets to the constants that they name; it takes a few values only, so each is raised a few times
    need |= {(name, None): 0.0 for name, _ in list(need)}
    work = [g for g, x in need.items() if x]
    while work:
        g = work.pop()
        for to in leads[g]:
            if need[to] < need[g]:
                need[to] = need[g]
                work.append(to)

    out: dict[tuple[int, int], None] = {}
    scores: dict[tuple, float] = {}

    def score(of: list[tuple[int, int]]) -> float:
        """How the places together look; the same ones are read once."""
        key = tuple(of)
        if key not in scores:
            scores[key] = literal_score("".join(text[a:b] for a, b in of))
        return scores[key]

    for i, (_, _, parts) in enumerate(found):
        if not need[group[i]]:
            continue
        said, places = [], []
        for start, end, reference in parts:
            known = meant(i, reference) if reference else None
            if known:  # a constant's own literals, as its last definition has them
                own = [(a, b) for a, b, further in found[last[known]][2] if not further] if last[known] != i else []
                said += own
                places += own if len(parts) > 1 else []
            elif not reference or score([(start, end)]) >= 0.8:
                said.append((start, end))
                places.append((start, end))
        if places and need[group[i]] * score(said) >= LEAST_SCORE:
            out |= dict.fromkeys(places)
    return [(a, b, "literal") for a, b in out]


def spans(text: str) -> tuple[list, list]:
    """The base spans, and all spans: literals inside a base span add nothing."""
    base = base_spans(text)
    starts = sorted((a, b) for a, b, _ in base)
    reach = list(accumulate((b for _, b in starts), max))
    inside = lambda a, b: (k := bisect_right(starts, (a, len(text)))) and reach[k - 1] >= b
    more = [x for x in literal_spans(text) if not inside(x[0], x[1])]
    order = lambda x: (x[0], KINDS.index(x[2]), x[1])
    return sorted(base, key=order), sorted(base + more, key=order)


def _joined(found: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, n_assign, n_access, n_hex, base_sha256, spans."""

    def row(text: str | None) -> list:
        base, every = spans(text or "")
        kinds = Counter(k for _, _, k in base)
        return [kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)]

    return map_rows(df, [id_column, text_column], "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", row)


def mask(text: str | None, by: str = "[SECRET]") -> str | None:
    """The text with each maximal run of overlapping spans replaced; null stays null."""
    if not text:
        return text
    out, last = [], 0
    for a, b, _ in spans(text)[1]:
        if a >= last:
            out += [text[last:a], by]
        last = max(last, b)
    return "".join(out) + text[last:]


def redact(df: DataFrame, text_column: str = "text", by: str = "[SECRET]") -> DataFrame:
    """All columns, secrets in the text replaced."""
    return replace_text(df, text_column, lambda t: mask(t, by))
