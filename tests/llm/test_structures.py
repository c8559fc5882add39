"""The prefix trie, periodic runs and license scans against brute force, with odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marblework.llm import licenses, periodic, registered, trie

EMPTY = hashlib.sha256(b"").hexdigest()


# ---- prefix trie


def plain_nodes(convs):
    """Nodes by dictionaries of prefixes; convs: {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    under = defaultdict(lambda: [0, 0, 0])
    kids = defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            under[k[:d]][0] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
            under[k[:d]][1] += k not in kids
    out = set()
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), under[k][1], under[k][0], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def table(spark, convs, parts=5):
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)


def got_nodes(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("sizes", [(1, 1), (3, 10), (8192, 1 << 16)])
def test_trie_by_brute_force(spark, sizes):
    rng = random.Random(11)
    convs = {c: [(rng.choice("ua"), rng.choice(["", "x", "yy", "é😀"])) for _ in range(rng.randint(1, 5))] for c in rng.sample(range(-50, 1000), 150)}
    copies = [("u", "one first turn"), ("a", "that very many share")]
    convs |= {c: copies for c in range(2000, 2300)} | {c: [*copies, ("u", str(c % 7))] for c in range(3000, 3050)}
    got = got_nodes(trie.nodes(trie.gather(table(spark, convs)), *sizes))
    assert len(got) == len(set(got)) and set(got) == plain_nodes(convs)


def test_trie_query_by_brute_force(spark, tiny):
    import zlib

    rows = sorted((r["conv_id"], r["turn"], r["role"] or "", r["text"] or "") for r in spark.read.parquet(f"{tiny}/conversations.parquet").collect())
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    convs = {c: own.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + turns[h:] for c, turns in own.items()}
    assert set(got_nodes(registered.op11_prefix_trie(spark, tiny))) == plain_nodes(convs)


def test_trie_of_turnless_conversations(spark):
    convs = spark.createDataFrame([(5, []), (3, []), (4, [("0" * 32, 2)])], f"conv_id long, turns {trie.TURNS}")
    ends = hashlib.sha256(b"3,5").hexdigest()
    four = hashlib.sha256(b"4").hexdigest()
    assert set(got_nodes(trie.nodes(convs))) == {(3, 0, None, 3, 1, 1, 0, ends), (4, 1, 3, 1, 0, 1, 0, four)}
    assert got_nodes(trie.nodes(convs.filter("conv_id < 5 AND size(turns) = 0"))) == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]


def test_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, path binary, part int, turns string, n long"
    rows = [(1, None, None, None), (1, 0, "a", "x" * 300_000), (1, 0, "a", "x" * 300_000), (2, None, "", ""), (2, 1, "a", None), (None, 0, "a", "nobody's"), (3, 0, "a\n", "b"), (4, 0, "a", "\nb")]
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], schema)
    long = ("a", "x" * 300_000)
    assert set(got_nodes(trie.nodes(trie.gather(df)))) == plain_nodes({1: [("", ""), long, long], 2: [("", ""), ("a", "")], 3: [("a\n", "b")], 4: [("a", "\nb")]})
    assert got_nodes(trie.nodes(trie.gather(df.limit(0)))) == []


def test_trie_of_one_very_long_conversation(spark):
    turns = [(f"{i:032x}", i % 5) for i in range(20_000)]
    convs = spark.createDataFrame([(1, turns), (2, turns[:15_000])], f"conv_id long, turns {trie.TURNS}")
    got = {r[1]: r for r in got_nodes(trie.nodes(convs))}
    assert len(got) == 20_001 and got[0][6] == sum(i % 5 for i in range(15_000)) and got[15_000][7] == hashlib.sha256(b"2").hexdigest()


def test_sparse_table_extents():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 4, 300)
    levels = trie.minima(values)
    at, depth = np.repeat(np.arange(300), 5), np.tile(np.arange(5), 300)
    right, left = trie.reach_right(levels, at, depth), trie.reach_left(levels, at, depth)
    for i, d, r, x in zip(at, depth, right, left, strict=True):
        e = i
        while e + 1 < 300 and values[e + 1] >= d:
            e += 1
        b = i
        while b > 0 and values[b] >= d:
            b -= 1
        assert (r, x) == (e, b)
    assert (trie.least_within(levels, left, right) == [values[a : b + 1].min() for a, b in zip(left, right, strict=True)]).all()


# ---- periodic runs


def plain_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def made_texts(rng, n):
    out = []
    for _ in range(n):
        words = []
        while rng.random() < 0.8:
            kind = rng.random()
            if kind < 0.5:
                unit = [rng.choice("abcde") for _ in range(rng.choice([1, 2, 3, 5, 8, 15, 16, 17, 20, 24, 25, 33, 50, 90]))]
                k = rng.randint(len(unit), 7 * len(unit))
                words += (unit * 8)[:k]
            else:
                words += [rng.choice("ab" if kind < 0.7 else "abcdefghij") for _ in range(rng.randint(0, 60))]
        out.append([w.encode() for w in words])
    return out


def test_periodic_runs_by_brute_force():
    rng = random.Random(12)
    texts = made_texts(rng, 400) + [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4]
    for i in range(0, len(texts), 40):
        for words, runs in zip(texts[i : i + 40], periodic.find_runs(texts[i : i + 40]), strict=True):
            assert runs == plain_runs(words), words
    # a period whose words hold a shorter repetition, and one of Fibonacci words
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    for words in ([*fib[-1]], [*("aabaab" * 3 + "c") * 9], [*"ab" * 40 + "c"] * 5):
        words = [w.encode() for w in words]
        assert periodic.find_runs([words])[0] == plain_runs(words)


def test_periodic_texts_of_one_word_take_linear_time():
    begun = time.time()
    for words in ([b"a"] * 500_000, [b"%d" % (i % 12_345) for i in range(500_000)]):
        (run,) = periodic.find_runs([words])[0]
        assert run[:2] == (0, 500_000) and len(periodic.kept_words(words, [run])) == run[2]
    assert time.time() - begun < 30


def test_periodic_query_by_brute_force(spark, tiny):
    import zlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    planted = 0
    for r in registered.op12_periodic_runs(spark, tiny).collect():
        words, d = re.findall("[^\x20\x09-\x0d]+", texts[r["doc_id"]] or ""), r["doc_id"]
        h, n = zlib.crc32(str(d).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda x: (-(x[1] * 10**9 // x[2]), x[0], x[2]), default=(None, None, None))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert r.asDict() == {
            "doc_id": d, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        }
    assert planted


def test_periodic_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "la " * 400_000), (4, "la " * 400_000), (None, "ha ha ha ha ha ha"), (5, "one\x1ftwo " * 7)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, runs string, collapsed string, n_words long")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.scan(df).collect()), key=repr)
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 400_000, [(0, 400_000, 1)], "la"), (4, 400_000, [(0, 400_000, 1)], "la"), (0, 6, [(0, 6, 1)], "ha"), (5, 7, [(0, 7, 1)], "one\x1ftwo")], key=repr)
    assert periodic.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="times"):
        periodic.scan(df, times=3)


# ---- license scans


def license_words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_scan(text, known):
    words, places, labels, score = license_words(text), [], set(), 0.0
    for t in known:
        m = len(t["row"])
        for i in range(len(words)):
            if t["phrase"]:
                if words[i : i + m] == t["row"]:
                    places.append((i, t["label"]))
                    labels.add(t["label"])
                    score = 1.0
            else:
                met = len(set(words[i : i + m]) & set(t["words"]))
                if met >= t["need"]:
                    labels.add(t["label"])
                    score = max(score, met / len(t["words"]))
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in places}), sorted(labels), score)


def scanned(df, known=None):
    return [(r["doc_id"], tuple(r)[1:]) for r in licenses.scan(df, known).collect()]


def same(got, want):
    return got[:-1] == want[:-1] and abs(got[-1] - want[-1]) < 1e-12


def test_licenses_by_brute_force(spark):
    rng, known = random.Random(13), licenses.templates()
    pool = sorted({w for t in known for w in t["words"]}) + ["filler", "wörter", "und", "noch", "mehr"]
    texts = {}
    for i in range(300):
        words = []
        for _ in range(rng.randint(0, 6)):
            t = rng.choice(known)["row"]
            words += [rng.choice(pool) if rng.random() < 0.12 else w for w in t if rng.random() > 0.08] if rng.random() < 0.6 else rng.choices(pool, k=rng.randint(0, 90))
        texts[i] = rng.choice([" ", "\n", ", "]).join(w.upper() if rng.random() < 0.2 else w for w in words)
    got = scanned(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3))
    assert len(got) == len(texts)
    labels = set()
    for d, x in got:
        assert same(x, plain_scan(texts[d], known)), texts[d]
        labels |= set(x[5])
    assert labels == {t["label"] for t in known}


def test_licenses_query_by_brute_force(spark, tiny):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    found = 0
    for r in registered.op13_license_scan(spark, tiny).collect():
        n, n_base, first, last, base, labels, score = plain_scan(texts[r["doc_id"]], licenses.templates())
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == (n, n_base, first, last, ",".join(base), ",".join(labels)) and abs(r["score"] - score) < 1e-12
        found += n_base
    assert found


def test_licenses_odd_tables(spark):
    notice = "Under the MIT License. " * 30_000
    rows = [(1, None), (2, ""), (3, "..."), (4, notice), (4, notice), (4, "cc by nc"), (None, "CC BY-NC 4.0"), (6, "x" * 500_000)]
    df = spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], "doc_id long, text string, `row` string, words string, hits string, label string, blocks string")
    got = sorted(scanned(df), key=repr)
    assert len(got) == len(rows)
    for d, x in got:
        assert any(same(x, plain_scan(t, licenses.templates())) for i, t in rows if i == d and t != notice) or d == 4 and x[:6] == (120_000, 30_000, 0, 119_996, ["mit"], ["mit"])
    assert scanned(df.limit(0)) == []
    with pytest.raises(ValueError, match="share"):
        licenses.templates(notices=[("x", 1.5, "words")])


def test_licenses_are_native(spark, tiny):
    plan = registered.op13_license_scan(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_frequent_words_are_not_joined(spark):
    """Of a template's words only the rarest are joined; a word that all texts hold is not among them."""
    known = licenses.templates()
    df = spark.createDataFrame([(i, "the license of the " + "text " * i) for i in range(50)] + [(99, "under the mit license")], "doc_id long, text string")
    blocks = licenses.cut_blocks(df, known, "doc_id", "text").select(F.explode("blocks").alias("b")).select("b.begin", "b.hits")
    joined = {(r["template"], r["word"]) for r in licenses.prefixes(blocks, known).collect()}
    assert {w for t, w in joined if t == 0} == {"mit"}
