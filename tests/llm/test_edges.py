"""Nulls in any column, empty and very long texts, ties and repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marblework.llm import bpe, chat, decontam, langid, near_dup, quality, secrets, substring, suffix, warc

VOCABULARY = __import__("public_tokenizers").path("byte_bpe_50k.json")
#: Columns that the operators use as names of their own.
CLASHES = "id long, n long, v string, unit string, hot string, component_id long, kept boolean, spans string, a long, b long, words string, _id long, _row long, lang_pred string, n_words long, raw string, digest string, `set` string, class string, start long, removed_spans string, _of long, _gone long, _text string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
LONG = "lorem ipsum dolor sit amet " * 20_000
TEXTS = [None, "", "   \n\t ", "a", "...", LONG, "x" * 200_000, "the same text of seven words here twice", "the same text of seven words here twice", "été \U0001f600 \x00 token = 'abcdefgh12345678'"]


def rows():
    found = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(TEXTS)]
    found += [found[7], (None, "a row without an id", "de", "s", 1), (None, None, None, None, None)]
    return [(*r, *[None] * CLASHES.count(",")) + (None,) for r in found]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the same text of seven words"), (1, "the same text of seven words"), (None, "lorem ipsum dolor sit amet lorem"), (2, None), (3, "")], "item_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def apply(name, df, spark, benchmark):
    if name == "bpe":
        return bpe.round_trip(df, VOCABULARY)
    if name == "decontam":
        return decontam.find(df, benchmark)
    if name == "quality":
        return quality.assess(df)
    if name == "secrets":
        return secrets.scan(df)
    if name == "suffix":
        return suffix.dedup(df)
    if name == "near_dup":
        return near_dup.link(df)
    if name == "langid":
        return langid.predict(df, langid.train(df, ~langid.held_out(df["doc_id"])))
    raise ValueError(name)


PER_ROW = ["bpe", "decontam", "quality", "secrets", "suffix", "near_dup", "langid"]


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(name, spark, docs, benchmark):
    got = apply(name, docs, spark, benchmark)
    assert got.count() == len(rows())


@pytest.mark.parametrize("name", PER_ROW)
def test_an_empty_table_gives_none(name, spark, empty, benchmark):
    assert apply(name, empty, spark, benchmark).count() == 0


def test_defined_results(spark, docs, benchmark):
    empty_sha = hashlib.sha256(b"").hexdigest()
    got = by_id(apply("bpe", docs, spark, benchmark))
    assert got[0]["n_tokens"] == got[1]["n_tokens"] == 0 and got[0]["ids_sha256"] == empty_sha
    assert got[5]["decoded_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()
    got = by_id(apply("decontam", docs, spark, benchmark))
    assert (got[0]["n_words"], got[0]["contaminated"]) == (0, False)
    assert got[7]["items"] == ["1"] and got[7]["contaminated"] and got[5]["n_hit"] > 0
    got = by_id(apply("quality", docs, spark, benchmark))
    assert got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    got = by_id(apply("secrets", docs, spark, benchmark))
    assert got[0]["spans"] == "" and got[9]["n_assign"] == 1
    got = by_id(apply("suffix", docs, spark, benchmark))
    assert got[0]["n_bytes"] == 0 and got[5]["n_removed"] == len(LONG) and got[6]["n_removed"] == 200_000
    assert got[7]["n_removed"] == 0
    got = by_id(apply("near_dup", docs, spark, benchmark))
    assert got[0]["n_shingles"] == got[2]["n_shingles"] == 0 and got[0]["component_id"] == 0
    assert got[8]["component_id"] == 7 and not got[8]["kept"] and got[7]["kept"]
    got = by_id(apply("langid", docs, spark, benchmark))
    assert got[0]["lang_pred"] == got[4]["lang_pred"] == "und" and got[3]["lang_pred"] != "und"


def test_an_empty_benchmark_hits_nothing(spark, docs, benchmark):
    assert decontam.find(docs, benchmark.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0


def test_substring(spark, docs, empty):
    assert substring.repeated_units(empty).count() == 0
    assert substring.dedup(empty).columns[: len(empty.columns)] == empty.columns
    more = docs.unionByName(spark.createDataFrame([(50, "the same text of seven words here twice or more")] * 1, "doc_id long, text string"), allowMissingColumns=True)
    got = substring.repeated_units(more, min_words=8).filter("doc_id = 8").collect()
    assert [(r["start"], r["first_doc_id"]) for r in got] == [(0, 7)]
    cut = by_id(substring.dedup(docs, min_words=8))
    assert cut[0]["text"] is None and cut[7]["text"] == TEXTS[7] and cut[8]["text"] == ""


def test_near_dup_keeps_null_ids_and_columns(docs, empty):
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2 and 8 not in ids and 0 in ids
    assert near_dup.keep_one(empty).count() == 0


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, pack string, members string"
    rows = [(1, 0, None, None, None, None), (1, 0, None, None, None, None), (1, None, "assistant", "x" * 300_000, None, None), (None, 1, "user", "no id", None, None), (2, 0, "assistant", "", None, None)]
    got = {r["conv_id"]: r for r in chat.read_back(chat.pack_trees(spark.createDataFrame(rows, schema))).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 300_000 and got[None]["n_turns"] == 1
    assert got[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.read_back(chat.pack_trees(spark.createDataFrame([], schema))).count() == 0


def test_warc_empty_and_long(spark, tmp_path):
    schema = "page_id long, url string, html string, sha string, owner long"
    assert warc.read(warc.write(spark.createDataFrame([], schema), f"file://{tmp_path}/none")).count() == 0
    df = spark.createDataFrame([(1, "u", "y" * 3_000_000, None, None), (1, "u", "y" * 3_000_000, None, None), (0, None, "y" * 3_000_000, None, None)], schema)
    got = sorted((r["page_id"], r["record_type"], r["payload_bytes"]) for r in warc.read(warc.write(df, f"file://{tmp_path}/long"), split_bytes=1000).collect())
    assert got == [(0, "revisit", 3_000_000), (1, "response", 3_000_000), (1, "response", 3_000_000)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_stand_odd_tables(name, spark, docs, empty, tiny):
    stage = dict(corpus_pipeline.STAGES)[name]
    for df in (docs, empty):
        out = stage(spark, df, tiny)
        assert name == "tokens" or out.columns == df.columns
        assert out.count() <= df.count()


def _plain_words(text):
    """Lower-cased runs of ASCII letters and digits and of other characters than ASCII."""
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def _plain_shingles(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    m = min(5, len(words))
    return {tuple(words[i : i + m]) for i in range(len(words) - m + 1)} if words else set()


def test_pipeline_by_brute_force(spark, tiny):
    """Near copies, contamination and token ids are computed anew here; the language filter is checked by what must stay and go, masks by the base patterns."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    model = langid.Model(langid.train(docs, F.lit(True)))
    every = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    texts = {d: t for d, t in every.items() if model.is_language(t)}
    assert not [d for d, t in every.items() if d not in texts and len(_plain_words(t)) > 60]
    assert not [d for d, t in texts.items() if not any(c.isalpha() for c in t)]
    sets = {d: _plain_shingles(t) for d, t in texts.items()}
    group = {d: d for d in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                u, v = top(a), top(b)
                group[max(u, v)] = min(u, v)
    texts = {d: t for d, t in texts.items() if top(d) == d}
    windows = {}
    for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect():
        words = _plain_words(r["text"])
        m = min(13, len(words))
        windows |= {tuple(words[i : i + m]): m for i in range(len(words) - m + 1) if m}
    known, want = Tokenizer.from_file(VOCABULARY), {}
    known.no_truncation()
    base = [r"(?ia:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{8,})", r"(AKIA[A-Z0-9]{12,})", r"([0-9a-f]{32,})"]
    for d, t in texts.items():
        words, hit = _plain_words(t), set()
        for m in set(windows.values()):
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) in windows:
                    hit.update(range(i, i + m))
        if not (hit and 20 * len(hit) >= len(words)):
            masked = secrets.mask(t)
            assert not [p for p in base if re.search(p, masked)]
            want[d] = b"".join(i.to_bytes(4, "little") for i in known.encode(masked, add_special_tokens=False).ids)
    got = {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, tiny).collect()}
    assert got == want


def test_stages_keep_clashing_columns_and_every_language(spark, tiny):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("the house is by the river and the boat is on it " * 3, "en"), ("la maison est au bord de la mer et le bateau aussi " * 3, "fr"), ("das haus liegt am fluss und das boot auch " * 3, "de")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = df.unionByName(spark.createDataFrame([(9, " ".join(r[1] for r in rows), None, "s", 1)], df.schema))
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, mixed, tiny).collect()} == {0, 1, 2, 9}
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, bare, tiny).count() == 3
