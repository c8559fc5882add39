r"""License scans: an exact set-similarity join of text blocks with license templates.

A text's words are lower-cased (A-Z only) runs of ASCII letters, digits and other
characters than ASCII.  It is cut into blocks of ``2 * span`` words, one every
``span`` words, where ``span`` is the longest template's number of words, so every
stretch as long as a template lies in a block.  A block's set has its distinct
words that any template has.

1. One aggregate over all blocks counts how many hold each word: the global order,
   rarest first.
2. Of a template's distinct words in that order, a block that holds ``c`` of them
   must hold one of the first ``size - c + 1``: only those are joined (prefix
   filter).  Blocks of fewer than ``c`` words drop out (length filter), as do those
   where the words that follow in either order are too few (positional filter).  A
   pair is kept for its first common word only, so it occurs once.
3. What remains is decided exactly: in the block, at each place of a template word,
   the template's words within as many words as the template has are counted.  A
   phrase, whose words must stand in a row, is looked for word by word.

All of this is DataFrame work.  Templates are a parameter: the joined prefix has at
most as many rows as they have words (``MOST_WORDS`` in all, checked), so it is
broadcast; blocks, each of bounded size, never move.  What is shuffled is one row
per text and its hits, summed by task before.  A frequent word is never in a
prefix unless a template has nothing rarer.

Null text counts as empty: no words and no labels.  Texts are read whole, whatever
their length, and cut into blocks in the task that reads them.  Every row is one
text, so repeated rows get equal results, whatever their ids; an empty table gives
an empty one.  Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut

#: Words of all templates together, at most.
MOST_WORDS = 100_000
#: Phrases with their labels; their words must stand consecutively.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Fixed values: (label, share of the distinct words that must be met, opening or notice of the license).
NOTICES = [
    ("mit", 0.8, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", 0.8, "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", 0.8, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", 0.8, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", 0.8, "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3", 1.0, "gnu general public license version 3"),
    ("gpl-2", 1.0, "gnu general public license version 2"),
    ("lgpl", 1.0, "gnu lesser general public license"),
    ("agpl", 1.0, "gnu affero general public license"),
    ("mpl-2", 0.8, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", 0.8, "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", 0.9, "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", 0.9, "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", 0.8, "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_HITS = "array<struct<at: long, word: string>>"


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def templates(phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, float, str]] = NOTICES) -> list[dict]:
    """Templates as rows: number, label, whether a phrase, its words in a row, its distinct words and how many must be met."""
    rows = []
    for label, share, text, phrase in [(a, 1.0, b, True) for a, b in phrases] + [(*x, False) for x in notices]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        distinct = sorted(set(words))
        if not words or not 0 < share <= 1:
            raise ValueError(f"a template needs words and a share in (0, 1]: {label}")
        rows.append({"template": len(rows), "label": label, "phrase": phrase, "row": words, "words": distinct, "need": -int(-share * len(distinct) // 1)})
    if sum(len(r["row"]) for r in rows) > MOST_WORDS:
        raise ValueError(f"templates have more than {MOST_WORDS} words")
    return rows


def blocks_of(words: Column, known: list[str], span: int, least: int) -> Column:
    """The blocks with ``least`` known words or more, as structs of ``begin`` and ``hits``: places and known words."""
    starts = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / span).cast("int"))

    def block(k: Column) -> Column:
        placed = F.transform(F.slice(words, k * span + 1, F.lit(2 * span)), lambda w, i: F.when(w.isin(known), F.struct((k * span + i).cast("long").alias("at"), w.alias("word"))))
        return F.struct((k * span).cast("long").alias("begin"), F.array_compact(placed).alias("hits"))

    found = F.filter(F.transform(starts, block), lambda b: F.size(b["hits"]) >= least)
    return F.when(F.size(words) > 0, found).otherwise(F.array().cast(f"array<struct<begin: long, hits: {_HITS}>>"))


def cut_blocks(df: DataFrame, known: list[dict], id_column: str, text_column: str) -> DataFrame:
    """One written row per text: row (its number), id, n_words, blocks."""
    vocabulary = sorted({w for t in known for w in t["words"]})
    span, least = max(len(t["row"]) for t in known), min(t["need"] for t in known)
    words = df.select(F.monotonically_increasing_id().alias("row"), df[id_column].alias("id"), words_of(df[text_column].cast("string")).alias("words"))
    return cut(words.select("row", "id", F.size("words").cast("long").alias("n_words"), blocks_of(F.col("words"), vocabulary, span, least).alias("blocks")))


def prefixes(blocks: DataFrame, known: list[dict]) -> DataFrame:
    """The templates' words that are joined, each with what its template is: at most as many rows as templates have words.

    ``rarer`` are all words before this one in the global order, ``earlier`` the template's own among them.
    """
    spark = blocks.sparkSession
    kinds = spark.createDataFrame([tuple(t.values()) for t in known], "template int, label string, phrase boolean, row array<string>, words array<string>, need int")
    counts = blocks.select(F.explode(F.array_distinct(F.col("hits.word"))).alias("word")).groupBy("word").agg(F.count("*").alias("held_by"))
    every = kinds.select("template", F.explode("words").alias("word")).join(counts, "word", "left").withColumn("held_by", F.coalesce("held_by", F.lit(0)))
    order = every.groupBy().agg(F.array_sort(F.collect_set(F.struct("held_by", "word"))).alias("order")).select(F.transform("order", lambda x: x["word"]).alias("order"))
    ranked = F.filter("order", lambda w: F.array_contains("words", w))
    first = kinds.crossJoin(F.broadcast(order)).withColumn("words", ranked)
    each = first.select("*", F.posexplode(F.slice("words", F.lit(1), F.size("words") - F.col("need") + 1)).alias("i", "word"))
    rarer = F.slice("order", F.lit(1), F.array_position("order", F.col("word")).cast("int") - 1)
    return each.select("word", "i", "template", "label", "phrase", "row", "words", "need", F.size("words").alias("size"), F.slice("words", F.lit(1), F.col("i")).alias("earlier"), rarer.alias("rarer"))


def pairs(blocks: DataFrame, prefix: DataFrame) -> DataFrame:
    """Blocks with the templates of which they hold enough words, each pair once."""
    held = blocks.withColumn("held", F.array_distinct(F.col("hits.word")))
    met = held.select("*", F.explode("held").alias("word")).join(F.broadcast(prefix), "word")
    follow = 1 + F.least(F.col("size") - 1 - F.col("i"), F.size("held") - 1 - F.size(F.array_intersect("held", "rarer")))
    may = met.filter((F.size("held") >= F.col("need")) & (follow >= F.col("need")) & ~F.arrays_overlap("held", "earlier"))
    return may.filter(F.size(F.array_intersect("held", "words")) >= F.col("need"))


def places(found: DataFrame, span: int) -> DataFrame:
    """(row, label, phrase, at, share): where a template is met, each place in the one block whose first half has it."""
    own = F.filter("hits", lambda h: F.array_contains("words", h["word"]))
    stands = lambda h: F.forall(F.transform("row", lambda w, k: F.struct((h["at"] + k).alias("at"), w.alias("word"))), lambda x: F.array_contains("hits", x))

    def share(h: Column, k: Column) -> Column:
        near = F.filter(F.slice("own", k + 1, F.size("row")), lambda x: x["at"] < h["at"] + F.size("row"))
        return F.size(F.array_distinct(F.transform(near, lambda x: x["word"])))

    first_half = lambda h: h["at"] < F.col("begin") + span
    phrase = F.transform(F.filter("own", lambda h: first_half(h) & (h["word"] == F.get("row", F.lit(0))) & stands(h)), lambda h: F.struct(h["at"].alias("at"), F.col("size").alias("met")))
    notice = F.filter(F.transform("own", lambda h, k: F.when(first_half(h), F.struct(h["at"].alias("at"), share(h, k).alias("met")))), lambda x: x["met"] >= F.col("need"))
    at = F.explode(F.when(F.col("phrase"), phrase).otherwise(notice)).alias("x")
    return found.withColumn("own", own).select("text", "label", "phrase", "size", at).select("text", "label", "phrase", F.col("x.at").alias("at"), (F.col("x.met") / F.col("size")).alias("share"))


def scan(df: DataFrame, known: list[dict] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, n_words, n_base (places of phrases), first_word, last_word, base_labels, labels, score.

    Labels are arrays, sorted.  ``score`` is the largest share of a template's
    words that is met at one place, 0 where no template is met.
    """
    known = templates() if known is None else known
    texts = cut_blocks(df, known, id_column, text_column)
    blocks = texts.select(F.col("row").alias("text"), F.explode("blocks").alias("b")).select("text", "b.begin", "b.hits")
    found = places(pairs(blocks, prefixes(blocks, known)), max(len(t["row"]) for t in known))
    base = F.col("phrase")
    summed = found.groupBy("text").agg(
        F.sum(F.when(base, 1).otherwise(0)).alias("n_base"),
        F.min(F.when(base, F.col("at"))).alias("first_word"),
        F.max(F.when(base, F.col("at"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    none = F.array().cast("array<string>")
    return texts.select("row", "id", "n_words").join(summed, F.col("row") == F.col("text"), "left").select(
        F.col("id").alias(id_column), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
