"""Texts and tables that once took too long or left files behind."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from marblework.llm import bpe, chat, decontam, near_dup, substring, suffix, trie, warc
from marblework.llm.common import checkpoint_root
from test_operators import _brute_suffix


@pytest.mark.parametrize(("window", "core", "report", "split_over"), [(60, 12, 30, 99), (40, 13, 40, 99), (60, 12, 30, 3)])
def test_suffix_dedup_of_periodic_texts(spark, window, core, report, split_over):
    rng = random.Random(9)
    units = ["a", "ab", "abc", "-=", "x" * 7 + "y", "row;1\n", "".join(rng.choice("abcdefgh") for _ in range(23)), "z" * 40 + "!"]
    say = lambda n: "".join(rng.choice("abcxyz-=\n") for _ in range(n))
    rows = []
    for i in range(90):
        parts = []
        for _ in range(rng.randint(1, 4)):
            unit = rng.choice(units)
            parts += [(unit * 400)[: rng.choice([20, window - 1, window, window + 1, window + len(unit), 2 * window, 300])], say(rng.randint(0, 12))]
        rows.append((i, "".join(parts)))
    got = suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string"), window, core, report, split_over).collect()
    assert sorted(map(tuple, got)) == _brute_suffix(rows, window, report)


def test_suffix_dedup_of_megabytes_of_one_period(spark):
    texts = [" " * 1_000_000, "ab\n" * 400_000, "".join(f"{i % 10};" for i in range(60)) * 9_000, "x" + " " * 400, "y" + " " * 399]
    suffix.dedup(spark.createDataFrame([(9, "warm")], "doc_id long, text string")).collect()
    begun = time.time()
    got = {r["doc_id"]: r for r in suffix.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert time.time() - begun < 60
    assert [got[i]["n_removed"] for i in range(5)] == [len(texts[0]), len(texts[1]), len(texts[2]), 400, 0]
    assert [got[i]["has_passage"] for i in range(5)] == [True] * 5


def steps(spark):
    root = checkpoint_root(spark).removeprefix("file://")
    return {x for x in os.listdir(root) if x.startswith("step-")} if os.path.isdir(root) else set()


def test_steps_are_released(spark, tiny):
    docs, bench = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "benchmark"))
    convs, pages = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("conversations", "pages"))
    runs = (lambda: suffix.dedup(docs), lambda: near_dup.link(docs), lambda: decontam.find(docs, bench, chunk_bytes=500), lambda: substring.repeated_units(docs), lambda: trie.nodes(trie.gather(convs)), lambda: warc.write(pages, f"{checkpoint_root(spark)}/warc-test"))
    for run in runs:
        before = steps(spark)
        run().write.format("noop").mode("overwrite").save()
        assert len(steps(spark) - before) <= 1  # the result's own


def test_packs_in_tokens(spark, tiny):
    """Every conversation's tokens by its intervals decode to its turns; positions run on along them; shared tokens stand once."""
    path = __import__("public_tokenizers").path("byte_bpe_50k.json")
    rows = [(c, i, *t) for c, turns in enumerate([[("user", "hi there"), ("assistant", "hello"), ("user", f"{k} ### x")] for k in range(20)] + [[("user", "hi there")], [("assistant", "é\U0001f600")]]) for i, t in enumerate(turns)]
    convs = spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame([(c + 10_000, *x) for c, *x in rows], "conv_id long, turn long, role string, text string"))
    packs = chat.pack_trees(convs, max_chars=2000)
    codec, want = bpe.Codec(bpe.read_vocabulary(path)), {}
    for r in convs.collect():
        want.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    texts = {r["pack"]: r["text"] for r in packs.collect()}
    seen = set()
    for r in chat.tokens(packs, path).collect():
        ids, nodes = r["ids"], r["nodes"]
        assert codec.decode(ids) == texts[r["pack"]] and len(r["positions"]) == len(ids) // 4 == sum(n["end"] - n["start"] for n in nodes)
        for m in r["members"]:
            node = nodes[m["node"]]
            spans = [*((a["start"], a["end"]) for a in node["ancestors"]), (node["start"], node["end"])]
            at = [i for a, b in spans for i in range(a, b)]
            assert [r["positions"][i] for i in at] == list(range(len(at)))
            turns = [(role, text) for _, role, text in sorted(want[m["conv_id"]])]
            assert chat.parse(codec.decode(b"".join(ids[4 * a : 4 * b] for a, b in spans))) == turns
            loss, i = [], m["node"]
            while i >= 0:
                if nodes[i]["loss_start"] is not None:
                    loss.append(chat.unescape(codec.decode(ids[4 * nodes[i]["loss_start"] : 4 * nodes[i]["loss_end"]])))
                i = nodes[i]["parent"]
            assert loss[::-1] == [text for role, text in turns if role == chat.TRAINED_ROLE]
            seen.add(m["conv_id"])
    assert seen == set(want)
