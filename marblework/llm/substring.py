"""Substring dedup by hashing lines, sentences and runs of short sentences.

Each text is cut into lines, and lines into sentences.  Every non-blank line is
a unit, and so is every sentence of at least ``min_words`` words, so a repeated
passage inside a longer line is found too.  Shorter sentences (a line without
inner sentence ends is one) are joined with those that follow, and with those
before, over line ends, until they reach the bound: each start and each end of
such a run is a unit, so a repeated passage of short lines or sentences is found
wherever it stands.  In scripts without spaces two characters count as a word.
Units are normalised and digested; digests are grouped globally; the occurrence
of the least (id, start) stays and all others are removed.  Removed spans keep
their offsets (code points, end exclusive) in the original text.

Texts are cut and digested once and their units written.  Grouping is
pre-aggregated per task, so a unit that a third of all rows share arrives once
per task.  The repeated digests are written too, so the join that brings the
kept place back to the other occurrences has plain exchanges on both sides and
Spark splits a hot digest.

Null and empty texts have no units.  A null id ranks first.  Ties are impossible: a place is an id and
an offset; repeated rows of one id count as one place.  An empty table gives
an empty one.  ``dedup`` puts its ``removed_spans`` in the place of a column of
that name; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, map_rows, release, unused

_END = re.compile(r"[.!?]+(?=\s)|[。！？]+[”’」』）]*")
#: Thai, Lao, Myanmar, Khmer, kana and Han, which put no spaces between words.
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿\U00020000-\U0003ffff]")


def normalised(unit: str) -> str:
    """Lower case with white space collapsed and the ends trimmed."""
    return " ".join(unit.split()).lower()


def units(text: str | None, min_words: int) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of each line, sentence with enough words and run of short sentences."""
    found: dict[tuple[int, int], bytes] = {}
    pieces: list[tuple[int, int, str, int]] = []
    unspaced = bool(_UNSPACED.search(text or ""))

    def add(start: int, end: int, plain: str) -> None:
        if (start, end) not in found:
            found[start, end] = hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def piece(start: int, end: int, plain: str) -> None:
        pieces.append((start, end, plain, plain.count(" ") + 1 + (len(_UNSPACED.findall(plain)) // 2 if unspaced else 0)))

    at = 0
    for line in (text or "").split("\n"):
        plain = normalised(line)
        if plain:
            add(at, at + len(line), plain)
            cuts, start = [], 0
            for m in _END.finditer(line):
                cuts.append((start, m.end()))
                start = m.end()
            if cuts and line[start:].strip():
                cuts.append((start, len(line)))
            if len(cuts) > 1:
                for a, b in cuts:
                    said = line[a:b]
                    piece(at + b - len(said.lstrip()), at + b, normalised(said))
            else:
                piece(at, at + len(line), plain)
        at += len(line) + 1
    for i, (start, end, plain, size) in enumerate(pieces):
        if size >= min_words:
            add(start, end, plain)
            continue
        j, n = i, size
        while n < min_words and j + 1 < len(pieces):
            j += 1
            n += pieces[j][3]
        if n >= min_words:
            add(start, pieces[j][1], " ".join([x[2] for x in pieces[i : j + 1]]))
        j, n = i, size
        while n < min_words and j:
            j -= 1
            n += pieces[j][3]
        if n >= min_words:
            add(pieces[j][0], end, " ".join([x[2] for x in pieces[j : i + 1]]))
    return [(a, b, d) for (a, b), d in found.items()]


def repeated_units(df: DataFrame, min_words: int = 8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per removed unit: id, start, end, first_<id>, first_start."""
    listed = map_rows(df, [id_column, text_column], "_units array<struct<start: long, end: long, digest: binary>>", lambda text: [[{"start": a, "end": b, "digest": d} for a, b, d in units(text, min_words)]])
    one = cut(listed.select(F.col(id_column).alias("_id"), F.explode("_units").alias("_u")).select("_id", F.col("_u.start").alias("start"), F.col("_u.end").alias("end"), F.col("_u.digest").alias("digest")))
    first = cut(one.groupBy("digest").agg(F.min(F.struct("_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    out = cut(
        one.join(first, "digest")
        .filter(~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("start") == F.col("first.start"))))
        .select(F.col("_id").alias(id_column), "start", "end", F.col("first._id").alias(f"first_{id_column}"), F.col("first.start").alias("first_start"))
    )
    release(one, first)
    return out


def merged_spans(removed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per id with removals: the united spans as array<struct<start, end>>, ordered.

    A row's spans are bounded by its text's length.
    """
    spans = F.array_sort(F.collect_set(F.struct("start", "end")))
    joined = F.aggregate(
        spans,
        F.array().cast("array<struct<start: bigint, end: bigint>>"),
        lambda a, x: F.when((F.size(a) > 0) & (F.element_at(a, -1)["end"] >= x["start"]), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(a, F.array(x))),
    )
    return removed.groupBy(id_column).agg(joined.alias("spans"))


def dedup(df: DataFrame, min_words: int = 8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``df`` with the text cut, and ``removed_spans`` of the original text (null: none)."""
    of, cuts = unused(df, "_of"), unused(df, "_cuts")
    spans = merged_spans(repeated_units(df, min_words, id_column, text_column), id_column).select(F.col(id_column).alias(of), F.col("spans").alias(cuts))
    text = F.col(f"`{text_column}`")
    kept = F.aggregate(
        cuts,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("end")),
        lambda a, x: F.struct(F.concat(a["out"], F.substring(text, (a["end"] + 1).cast("int"), (x["start"] - a["end"]).cast("int"))).alias("out"), x["end"].alias("end")),
        lambda a: F.concat(a["out"], F.substring(text, (a["end"] + 1).cast("int"), F.length(text))),
    )
    given = {text_column: F.coalesce(kept, text).alias(text_column), "removed_spans": F.col(cuts).alias("removed_spans")}
    names = [*df.columns, *(["removed_spans"] if "removed_spans" not in df.columns else [])]
    return df.join(spans, df[id_column].eqNullSafe(spans[of]), "left").select(*[given.get(c, F.col(f"`{c}`")) for c in names])
