"""Each operator against a brute-force version, a round trip or held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marblework.llm import bpe, chat, decontam, graph, langid, near_dup, quality, registered, secrets, substring, suffix, warc

VOCABULARY = __import__("public_tokenizers").path("byte_bpe_50k.json")


def _texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_bpe_equals_the_library(spark, tiny):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(VOCABULARY)
    known.no_truncation()
    texts = _texts(spark, tiny)
    for r in registered.op3_bpe(spark, tiny).collect():
        ids = known.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(known.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    known, codec = Tokenizer.from_file(VOCABULARY), bpe.Codec(bpe.read_vocabulary(VOCABULARY))
    rng = random.Random(5)
    texts = ["", " ", "  a", "a  ", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "it's I'LL\n\n 've", "a" * 3000, "ab" * 700, "😀é" * 300, "　x y\x85z"]
    texts += ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x2FFF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(40)) for _ in range(200)]
    for text in texts:
        ids = known.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids), text
        assert codec.decode(codec.encode(text)) == text


def test_bpe_long_and_short_ways_agree():
    codec, rng = bpe.Codec(bpe.read_vocabulary(VOCABULARY)), random.Random(2)
    for _ in range(200):
        word = "".join(rng.choice("abenrtsh é") for _ in range(rng.randint(1, 60))).encode()
        assert codec.short(word) == codec.long(word)
        assert codec.encode_words([word])[word] == b"".join(i.to_bytes(4, "little") for i in codec.short(word))


def test_bpe_words_worked_on_together_and_forgotten(monkeypatch):
    from tokenizers import Tokenizer

    known, codec, rng = Tokenizer.from_file(VOCABULARY), bpe.Codec(bpe.read_vocabulary(VOCABULARY)), random.Random(3)
    monkeypatch.setattr(bpe, "GROUP", 500)
    monkeypatch.setattr(bpe, "REMEMBERED", 5_000)
    texts = [" ".join("".join(rng.choice("abcdeghinorstu,.'é") for _ in range(rng.choice([1, 2, 3, 5, 7, 9, 14, 30, 40]))) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert [codec.decode(x) for x in codec.encode_all(texts)] == texts
    for text, ids in zip(texts * 2, codec.encode_all(texts * 2), strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in known.encode(text, add_special_tokens=False).ids)


def test_quality_by_brute_force(spark, tiny):
    texts = _texts(spark, tiny)
    for r in quality.assess(spark.read.parquet(f"{tiny}/documents.parquet")).collect():
        text = texts[r["doc_id"]]
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        seen, dups = set(), 0
        for line in text.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dups += line in seen
                seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(hit) > 30 * len(words))
        assert not (r["kept"] and r["base_failed"])


def _plain_shares(text):
    """Shares of characters in repeated lines, n-grams and top n-grams, by dictionaries of tuples."""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    total = max(1, sum(map(len, words)))
    seen, lines = set(), 0
    for line in text.split("\n"):
        own = re.findall("[^\x20\x09-\x0d]+", line)
        if own:
            lines += sum(map(len, own)) if line in seen else 0
            seen.add(line)
    ngrams, top = {}, {}
    for k in range(2, 11):
        grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        first, later = {}, set()
        for i, g in enumerate(grams):
            if g in first:
                later |= set(range(i, i + k))
            first.setdefault(g, i)
        ngrams[k] = sum(len(words[j]) for j in later) / total
        top[k] = max((n * sum(map(len, g)) / total for g, n in Counter(grams).items() if n >= quality.TOP_TIMES), default=0.0)
    return lines / total, {k: ngrams[k] for k in quality.MOST_IN_NGRAMS}, {k: top[k] for k in quality.MOST_IN_TOP}


def test_quality_verdict_by_brute_force(spark, tiny):
    rng = random.Random(8)
    made = [" ".join(rng.choice(["ab", "cd", "efg", "h"]) + ("\n" if rng.random() < 0.2 else "") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    half = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    made += [f"{x}\n{x[: rng.randint(5, 250)]}\n{half()}" for x in (half() for _ in range(60))]
    kept = 0
    for text in [*_texts(spark, tiny).values(), *made]:
        got, (lines, ngrams, top) = quality.measure(text), _plain_shares(text or "")
        assert abs(got["line_share"] - lines) < 1e-9 and abs(got["ngram_share"] - max(ngrams.values())) < 1e-9
        assert abs(got["top_share"] - max(top.values())) < 1e-9
        good = lines <= quality.MOST_IN_LINES and all(ngrams[k] <= v for k, v in quality.MOST_IN_NGRAMS.items()) and all(top[k] <= v for k, v in quality.MOST_IN_TOP.items())
        assert got["kept"] == (good and not got["base_failed"])
        kept += got["kept"]
    assert kept > 20


def test_quality_verdict():
    rng = random.Random(1)
    clean = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(300))
    assert quality.measure(clean)["kept"]
    assert not quality.measure("buy this now " * 60)["kept"]
    assert not quality.measure("\n".join([clean[:200]] * 3 + [clean[200:300]]))["kept"]


def test_secrets_base_by_brute_force(spark, tiny):
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = _texts(spark, tiny)
    for r in registered.op7_secrets(spark, tiny).collect():
        text = texts[r["doc_id"]]
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
        kinds = Counter(k for _, _, _, k in found)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_secrets_method_propagates_constants():
    text = 'K1 = "qL9x82_ZmPa0vTr"\nname = "harmless words here"\nconfig.privateKey = K1\n'
    assert [text[a:b] for a, b, k in secrets.spans(text)[1] if k == "literal"] == ["qL9x82_ZmPa0vTr"]
    assert secrets.spans('greeting = "hello world again"; pwd = "changeme_please1"')[1] == []
    assert secrets.mask('a password = "abcdefgh1234" b') == 'a [SECRET]" b'
    assert secrets.mask(None) is None and secrets.mask("") == ""


@pytest.mark.parametrize(
    ("text", "literal"),
    [
        ('password: str = "Hunter2Hunter2"', "Hunter2Hunter2"),
        ('let api_key: String = "qL9x82_ZmPa0vTr";', "qL9x82_ZmPa0vTr"),
        ("static TOKEN: &'static str = \"qL9x82_ZmPa0vTr\";", "qL9x82_ZmPa0vTr"),
        ('def f(user: str, secret: dict[str, int] | None = "qL9x82_ZmPa0vTr"): pass', "qL9x82_ZmPa0vTr"),
        ("readonly pwd?: string = 'Hunter2Hunter2'", "Hunter2Hunter2"),
        ("pwd: 'str' = 'Hunter2Hunter2'", "Hunter2Hunter2"),
        ('passphrase = "correct horse battery staple"', "correct horse battery staple"),
        ('secret = """first Line1\n\n"second" Line2"""\nx = 1', 'first Line1\n\n"second" Line2'),
        ("secret = \'\'\'Hunter2\nHunter2\'\'\'", "Hunter2\nHunter2"),
        ("secret = `Hunter2\nHunter2`", "Hunter2\nHunter2"),
        ('pwd="Hunter2\nHunter2"\n', "Hunter2\nHunter2"),
        ("a:\n  - private_key: |\n      -----BEGIN KEY-----\n\n      qL9x82ZmPa0vTr\n    other: x\n", "-----BEGIN KEY-----\n\n      qL9x82ZmPa0vTr"),
        ("pwd: >-\n  Hunter2Hunter2\nother: 1", "Hunter2Hunter2"),
        ("password_" + "of_the_house_" * 9 + ' = "Hunter2Hunter2"', "Hunter2Hunter2"),
        ("pwd" + " " * 200 + '= "Hunter2Hunter2"', "Hunter2Hunter2"),
        ("conf['pwd'] = \"Hunter2Hunter2\"", "Hunter2Hunter2"),
        ('os.environ["API_SECRET"] = "qL9x82_ZmPa0vTr"', "qL9x82_ZmPa0vTr"),
        ('secrets[env] = "qL9x82_ZmPa0vTr"\nsecret["x"] = "qL9x82_ZmPa0vTs"', "qL9x82_ZmPa0vTs"),
        ('config.privateKey = K1\nx = 3\nK1 = "qL9x82_ZmPa0vTr"\n', "qL9x82_ZmPa0vTr"),
        ("<conf><user>bob</user><dbPassword>qL9x82_ZmPa0vTr</dbPassword></conf>", "qL9x82_ZmPa0vTr"),
        ('<add key="x" pwd="qL9x82_ZmPa0vTr"/>', "qL9x82_ZmPa0vTr"),
        ('pwd = os.getenv("DB_PASSWORD_NAME", "qL9x82_ZmPa0vTr")', "qL9x82_ZmPa0vTr"),
        ('let key: Key = 1;\nlet pwd = String::from("qL9x82_ZmPa0vTr");', "qL9x82_ZmPa0vTr"),
        ("Authorization: Bearer qL9x82.ZmPa0vTr-7", "qL9x82.ZmPa0vTr-7"),
        ("export SIGNING_KEY='qL9x82_ZmPa0vTr'", "qL9x82_ZmPa0vTr"),
        ("[db]\npwd = qL9x82_ZmPa0vTr\n", "qL9x82_ZmPa0vTr"),
        ('{"a": {"pwd": "qL9x82_ZmPa0vTr", "n": 5}}', "qL9x82_ZmPa0vTr"),
        ('A = "qL9x82_ZmPa0vTr"\nB = A\nC = B\nlogin(passphrase=C)', "qL9x82_ZmPa0vTr"),
        ('B = A\nA = B\npwd = A\nA = "qL9x82_ZmPa0vTr"', "qL9x82_ZmPa0vTr"),
        ('def f():\n  K = "qL9x82_ZmPa0vTr"\n  pwd = K\ndef g():\n  K = "Other9_Words8_Here"\n  print(K)\n', "qL9x82_ZmPa0vTr"),
    ],
)
def test_secrets_reads_every_form_of_value(text, literal):
    assert [text[a:b] for a, b, k in secrets.spans(text)[1] if k == "literal"] == [literal]
    assert literal not in secrets.mask(text)


@pytest.mark.parametrize(
    "text",
    [
        '#define PRIVATE_KEY "{}"',
        'private_key "{}"',
        "private_key {}",
        '{{"name": "private_key", "value": "{}"}}',
        "- name: PRIVATE_KEY\n  value: {}\n",
        '{{"value": "{}", "name": "private_key"}}',
        '<add key="privateKey" value="{}"/>',
        'config.set("private_key", "{}")',
        'setPrivateKey("{}")',
        'client.set_private_key("{}")',
        'private_key, x = "{}", "b"',
        '(X, private_key) = ("a", "{}")',
        'a, signing_key, c = 1, "{}", None',
        'private_key += "{}"',
        "PRIVATE_KEY ?= {}",
        'private_key ||= "{}"',
        "run --private-key {} --verbose",
        "https://h.it/?a=1&b=2&c=3&d=4&e=5&f=6&g=7&h=8&i=9&private_key={}&z=1",
    ],
)
def test_secrets_reads_what_stands_for_an_assignment(text):
    text = text.format("qL9x82_ZmPa0vTr")
    assert [text[a:b] for a, b, k in secrets.spans(text)[1] if k == "literal"] == ["qL9x82_ZmPa0vTr"]


def test_secrets_hints_hold_for_every_sensitive_name():
    assert all(any(h in k for h in secrets.HINTS) for k in secrets.SENSITIVE)
    assert secrets.mask('pass-Word_x.sec_ret = "qL9x82_ZmPa0vTr"') == 'pass-Word_x.sec_ret = "[SECRET]"'


def test_secrets_leaves_names_that_are_not_sensitive():
    for text in ('#define COLOUR_KIND "qL9x82_ZmPa0vTr"', 'colour "qL9x82_ZmPa0vTr"', '{"name": "colour", "value": "qL9x82_ZmPa0vTr"}', 'setColour("qL9x82_ZmPa0vTr")', 'x, y = "qL9x82_ZmPa0vTr", "b"', "run --colour qL9x82_ZmPa0vTr", 'getenv("private_key", "qL9x82_ZmPa0vTr")', "secret meetings", "the token was given"):
        assert secrets.spans(text)[1] == [], text


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ('signing_key = "qL9x82" + "_ZmPa0vTr"', ["qL9x82", "_ZmPa0vTr"]),
        ('signing_key = ("qL9x82"\n    "_ZmPa0vTr")', ["qL9x82", "_ZmPa0vTr"]),
        ("$pwd = 'qL9x82' . '_ZmPa0vTr';", ["qL9x82", "_ZmPa0vTr"]),
        ('A = "qL9x82"\nsigning_key = A + "_ZmPa0vTr"', ["qL9x82", "_ZmPa0vTr"]),
        ('K = "qL9x82_ZmPa0vTr"\nK = "harmless words are here"\npwd = K', ["qL9x82_ZmPa0vTr", "harmless words are here"]),
        ('pwd = f(g("qL9x82_ZmPa0vTr"), "Xq83_kkPw_01")', ["qL9x82_ZmPa0vTr", "Xq83_kkPw_01"]),
    ],
)
def test_secrets_reads_expressions(text, literals):
    assert sorted(text[a:b] for a, b, k in secrets.spans(text)[1] if k == "literal") == sorted(literals)


def _brute_literals(lines):
    """Of lines (name, value as written, literal or name of a constant): the literals that a sensitive name reaches."""
    reached, known = set(), {"db_password", "apiSecret", "signing-key"}
    while True:
        more = {v for n, v, _ in lines if n in known} - known
        if not more:
            break
        known |= more
    for n, _, literal in lines:
        if n in known and literal:
            reached.add(literal)
    return reached


def test_secrets_literals_by_brute_force():
    """Random programs of literals and chains of constants, in several syntaxes, in any order."""
    rng = random.Random(12)
    forms = ["{n} = {v}", "{n} := {v};", "const {n} = {v};", "{n}: {v}", "  {n} => {v},", "export {n}={v}"]
    for _ in range(300):
        names = ["db_password", "apiSecret", "colour", "title", *(f"K{i}" for i in range(6))]
        lines, written = [], []
        for n in rng.sample(names, rng.randint(2, 9)):
            if rng.random() < 0.5:
                literal = "".join(rng.choice("abcdefghjkmnpqrstuvw") + rng.choice("23456789") for _ in range(8))
                lines.append((n, literal, literal))
                written.append((n, f'"{literal}"'))
            else:
                to = rng.choice([x for x in names[4:] if x != n])
                lines.append((n, to, None))
                written.append((n, to))
        text = "\n".join(rng.choice(forms).format(n=n, v=v) for n, v in written)
        base = secrets.base_spans(text)
        got = {text[a:b] for a, b, _ in secrets.literal_spans(text)}
        assert got == _brute_literals(lines), (text, base)


def test_secrets_lexer_leaves_what_is_no_secret():
    for text in ('name: str = "Hunter2Hunter2"', 'f(pwd: str, b = "Hunter2Hunter2")', "pwd: 'tis the season, and they don't\nknow", "pwd: |\nother: Hunter2Hunter2", 'pwd: "'):
        assert secrets.spans(text)[1] == [], text


#: Up to a megabyte each, on one line unless the form asks for lines.
SPELLED = [
    "a=" * 500_000,
    "".join(f"k{i}=v{i}&" for i in range(80_000)),
    "".join(f"password{i}=v{i}&" for i in range(50_000)),
    "token=" * 170_000,
    "auth:" * 200_000,
    "pwd=example&" * 80_000,
    "a:b=" * 120_000,
    "private_key " * 80_000,
    "--pwd " * 170_000,
    "set_pwd(" * 60_000,
    "name='pwd',value='" * 55_000,
    "a, " * 330_000 + "= 1",
    'pwd += "x"; ' * 80_000,
    "big = '" + "x9" * 50_000 + "'\n" + "pwd = big\n" * 20_000,
    "password=abcdefgh1 pwd = 'qL9x82_ZmPa0vTr'\n" * 20_000,
    "a." * 500_000 + "= 1",
    '"pwd", ' * 140_000,
]


def test_secrets_lexer_takes_linear_time():
    for text in ("a: [b " * 100_000, 'pwd = "' * 50_000, "pwd: |\n" * 50_000, "pwd" + " " * 300_000 + "= = =", "x" * 300_000 + ": y", "a:" + "<" * 300_000, *SPELLED):
        start = time.process_time()
        secrets.spans(text)
        assert time.process_time() - start < 10


def test_secrets_whole_match_is_dropped_when_short():
    text = "password = token: abcdefgh12 AKIAABC AKIA" + "A" * 12
    kinds = [(k, text[a:b]) for a, b, k in secrets.base_spans(text)]
    assert kinds == [("access", "AKIA" + "A" * 12)]


def _brute_decontam(words_of, docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        m = min(13, len(words))
        for i in range(len(words) - m + 1) if m else ():
            windows[tuple(words[i : i + m])].add(str(item))
    sizes, out = {len(w) for w in windows}, {}
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for m in sizes:
            for i in range(len(words) - m + 1):
                if w := windows.get(tuple(words[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= w
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))
    return out


@pytest.mark.parametrize(("chunk", "small"), [(8_000_000, False), (60, False), (60, True)])
def test_decontamination_by_brute_force(spark, monkeypatch, chunk, small):
    if small:  # tables in which everything falls together make candidates, and no other result
        monkeypatch.setattr(decontam, "SLOTS", 1)
        monkeypatch.setattr(decontam, "BITS", 8)
    rng = random.Random(9)
    plain = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    say = lambda n: " ".join(rng.choice("a B c d é1") for _ in range(n))
    items = [(1, "one"), (2, "A b"), (3, None), (4, ""), (10, say(14)), (11, say(20)), (12, "--- ... "), (5, "x y z " * 9), (6, "x y z " * 9)]
    docs = [(i, " ".join(rng.choice([say(5), items[rng.randrange(len(items))][1] or "", "ONE."]) for _ in range(rng.randint(0, 9)))) for i in range(60)] + [(100, None), (101, "")]
    got = decontam.digest(decontam.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), chunk_bytes=chunk)).collect()
    want = _brute_decontam(plain, docs, items)
    assert {r[0]: tuple(r)[1:] for r in got} == want
    kept = decontam.keep_clean(spark.createDataFrame(docs, "doc_id long, text string").withColumn("_row", F.lit("x")), spark.createDataFrame(items, "item_id long, text string"), chunk_bytes=chunk)
    assert kept.columns == ["doc_id", "text", "_row"]
    assert sorted(r[0] for r in kept.collect()) == sorted(d for d, x in want.items() if not x[-1])


def test_near_dedup_by_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([30, 120, 400]))] for _ in range(12)]
    hot = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for i in range(260):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, len(words) // 20)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words = words[: rng.randint(5, 40)] + hot
        docs.append((i, " ".join(words)))
    docs += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, docs[0][1]), (506, docs[0][1])]
    sets = {d: near_dup.shingle_set(t) for d, t in docs}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    plain = {d: set(s.tolist()) for d, s in sets.items()}
    for a, x in plain.items():
        for b, y in plain.items():
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                u, v = top(a), top(b)
                up[max(u, v)] = min(u, v)
    got = near_dup.link(spark.createDataFrame(docs, "doc_id long, text string"), k=32, sieve=16).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {d: (len(s), top(d), top(d) == d) for d, s in plain.items()}


def test_near_dedup_with_one_value_in_a_third_of_the_texts(spark):
    """A passage that is most of each text of a third of the rows: one long list, few links."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(60)]
    docs = [(i, " ".join(passage + [word() for _ in range(rng.randint(8, 30))]) if i % 3 == 0 else " ".join(word() for _ in range(70))) for i in range(240)]
    docs += [(1000 + i, t + " more") for i, t in docs[::17]]
    sets = {d: set(near_dup.shingle_set(t).tolist()) for d, t in docs}
    edges = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 75 * len(x | y)]
    want = {d: d for d in sets}
    for _ in sets:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    got = near_dup.link(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_components_of_a_star_and_odd_links(spark):
    star = [(0, i) for i in range(1, 3000)] + [(None, 5), (6, None), (7, 7), (9, 9), (0, 1), (1, 0)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(3000), 0)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 150)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 100}


def _repeats(raws, window):
    """Per text, which bytes a repeated string of ``window`` bytes covers."""
    seen = Counter(b[i : i + window] for _, b in raws for i in range(len(b) - window + 1))
    for _, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        yield gone


def _brute_suffix(rows, window, report):
    raws, out = [(d, (t or "").encode()) for d, t in rows], []
    for (d, b), gone, passages in zip(raws, _repeats(raws, window), _repeats(raws, report), strict=True):
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest(), sum(passages), any(passages)))
    return sorted(out)


@pytest.mark.parametrize(("window", "core", "report", "split_over"), [(40, 13, 40, 99), (40, 30, 30, 99), (41, 8, 25, 99), (60, 12, 30, 2), (45, 12, 40, 12)])
def test_suffix_dedup_by_brute_force(spark, window, core, report, split_over):
    rng = random.Random(3)
    say = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [say(n) for n in (60, 100, 41, 39, 80, 45, 150, 30, 29)]
    rows = [(i, "".join(rng.choice([rng.choice(passages), say(rng.randint(1, 60))]) for _ in range(rng.randint(0, 8)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "a" * 500), (203, "ab" * 300), (204, "x" * 39), (205, rows[5][1]), (205, rows[5][1]), (206, "a" * 90), (207, "é" * 17), (208, "é" * 17)]
    got = suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string"), window, core, report, split_over).collect()
    assert sorted(map(tuple, got)) == _brute_suffix(rows, window, report)


def test_suffix_dedup_splits_a_gram_of_very_many_places(spark):
    rng = random.Random(7)
    say = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = say(90)
    rows = [(i, say(rng.randint(0, 50)) + passage[: rng.choice([90, 90, 80, 61])] + say(rng.randint(0, 50))) for i in range(150)]
    got = suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 60, 16, 40, 10).collect()
    assert sorted(map(tuple, got)) == _brute_suffix(rows, 60, 40)


def test_suffix_dedup_on_documents(spark, tiny):
    got = sorted(map(tuple, registered.op8_suffix_dedup(spark, tiny).collect()))
    assert got == _brute_suffix(_texts(spark, tiny).items(), 400, 256)


def test_loser_tree_merges():
    rng = random.Random(6)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30))) for _ in range(7)]
    coded = [suffix.front_code(r) for r in runs]
    opened = [iter([(s, k, None) for s, k in zip(suffix.front_decode(*c), c[0].tolist(), strict=True)]) for c in coded]
    merged = list(suffix.LoserTree(opened))
    assert [s for s, _, _ in merged] == sorted(sum(runs, []))
    assert all(k == suffix.shared(a[0], s, 0) for a, (s, k, _) in zip(merged, merged[1:], strict=False))


def test_substring_by_brute_force(spark, tiny):
    texts = _texts(spark, tiny)
    places = defaultdict(list)
    for d, t in texts.items():
        for a, b, h in substring.units(t, 8):
            places[h].append((d, a, b))
    want = sorted((d, a, b, min(p)[0], min(p)[1]) for p in places.values() if len(p) > 1 for d, a, b in p if (d, a, b) != min(p))
    assert sorted(map(tuple, registered.op5_substring_dedup(spark, tiny).collect())) == want


def test_substring_lines_and_soundness_by_brute_force(spark, tiny):
    """Without the operator's own units: every repeated line is removed but for its first place, and whatever is removed stands at the place that stays."""
    texts = _texts(spark, tiny)
    plain = lambda t: " ".join(re.findall(r"\S+", t)).lower()
    places = defaultdict(set)
    for d, t in texts.items():
        at = 0
        for line in (t or "").split("\n"):
            if plain(line):
                places[plain(line)].add((d, at, at + len(line)))
            at += len(line) + 1
    got = [tuple(r) for r in registered.op5_substring_dedup(spark, tiny).collect()]
    removed = {(d, a, b) for d, a, b, _, _ in got}
    later = {p for of in places.values() for p in of if p != min(of)}
    assert later and later <= removed
    for d, a, b, first, start in got:
        assert (first, start) < (d, a)
        assert plain(texts[first][start : start + 2 * (b - a) + 200]).startswith(plain(texts[d][a:b]))


def test_substring_with_one_line_in_a_third_of_the_rows(spark):
    rows = [(i, "the line that very many texts share" if i % 3 == 0 else f"own line {i}") for i in range(900)]
    got = substring.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(i, 0) for i in range(3, 900, 3)}


def test_substring_cuts_and_keeps_the_first(spark):
    passage = "these are more than eight words that two texts share here."
    df = spark.createDataFrame([(2, f"Second text is this. {passage} And an end."), (1, f"{passage}\nshort"), (3, "alone")], "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["removed_spans"]) for r in substring.dedup(df).collect()}
    assert out[1][0] == f"{passage}\nshort" and out[3][0] == "alone"
    assert passage not in out[2][0]
    (span,) = out[2][1]
    assert f"Second text is this. {passage} And an end."[span["start"] : span["end"]] == passage


@pytest.mark.parametrize(
    "passage",
    [
        "\n".join(f"six short words in verse {i}" for i in range(10)),
        "\n\n".join(f"six short words in verse {i}" for i in range(10)),
        "\n".join(f"a\tb\tc\td\te\tf\tg\t{i}" for i in range(7)),
        " ".join(f"This is short {i}." for i in range(13)),
        "Short one. " + " ".join(f"word{i}" for i in range(45)) + ". The end.",
        "".join(chr(0x4E00 + 7 * i % 20000) + ("。" if i % 12 == 11 else "") for i in range(120)),
        "\n".join("".join(chr(0xE01 + (7 * i + 5 * j) % 46) for j in range(24)) for i in range(5)),
    ],
)
def test_substring_removes_a_repeated_passage_wherever_it_stands(spark, passage):
    stop = "。" if passage.isalpha() or "。" in passage else "."
    own = lambda k: f"{chr(0x3B1 + k) * 9} opens text {k}{stop}"
    texts = [(1, f"{own(1)}\n{passage}\n{own(11)}"), (2, f"{own(2)} {passage} {own(12)}"), (3, f"{own(3)}\n{passage}")]
    out = {r["doc_id"]: r["text"] for r in substring.dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert out[1] == texts[0][1]
    squeeze = lambda t: "".join(t.split())
    assert squeeze(out[3]) == squeeze(own(3))
    if re.search("[.。]", passage):
        assert squeeze(out[2]) == squeeze(own(2) + own(12))


def test_substring_removes_repeated_short_lines(spark):
    out = {r["doc_id"]: r["text"] for r in substring.dedup(spark.createDataFrame([(1, "Share this\none"), (2, "two\nshare  this\n")], "doc_id long, text string")).collect()}
    assert out == {1: "Share this\none", 2: "two\n\n"}


def test_chat_packs_share_turns_once(spark):
    talk = lambda *xs: [("user" if i % 2 == 0 else "assistant", x) for i, x in enumerate(xs)]
    talks = {1: talk("hi", "yes"), 2: talk("hi", "no"), 3: talk("hi", "yes", "more"), 4: talk("hi", "yes"), 5: [(None, None), ("a:b", "### x </turn>\\")]}
    rows = [(c, i, r, t) for c, ts in talks.items() for i, (r, t) in enumerate(ts)]
    packs = chat.pack_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)).collect()
    text = "".join(p["text"] for p in packs)
    read = {}
    for p in packs:
        for m in p["members"]:
            node = p["nodes"][m["node"]]
            whole = "".join(p["text"][a["start"] : a["end"]] for a in node["ancestors"]) + p["text"][node["start"] : node["end"]]
            assert node["position"] + node["end"] - node["start"] == len(whole)
            assert list(chat.position_ids(node))[:1] == [node["position"]]
            read[m["conv_id"]] = chat.parse(whole)
    assert read == {c: [(r or "", t or "") for r, t in ts] for c, ts in talks.items()}
    if len(packs) == 1:
        assert text.count("### user: hi</turn>") == 1


def test_chat_packs_are_bounded(spark):
    rows = [(c, i, "user", f"{'shared' if i == 0 else c}{'x' * 50}") for c in range(100) for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    packs = chat.pack_trees(df, max_chars=1000, max_members=5).collect()
    assert max(len(p["text"]) for p in packs) <= 1000 and max(len(p["members"]) for p in packs) <= 5
    back = chat.read_back(chat.pack_trees(df, max_chars=1000)).collect()
    assert sorted(r["conv_id"] for r in back) == list(range(100)) and {r["n_turns"] for r in back} == {3}


@pytest.mark.parametrize("split", [300, 5000, 1 << 25])
def test_warc_round_trip(spark, split, tmp_path):
    rng = random.Random(8)
    pages = [(i, f"http://x/{i} a", rng.choice(["", "same", "é" * 50, rng.randbytes(300).hex(), None])) for i in range(120)] + [(-3, None, "same"), (None, None, "nobody's")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.read(warc.write(df, f"file://{tmp_path}/a"), split_bytes=split).collect()
    assert len(got) == len(pages)
    owner = defaultdict(lambda: None)
    for i, _, h in pages:
        if i is not None and (owner[h or ""] is None or i > owner[h or ""]):
            owner[h or ""] = i
    html = {i: h or "" for i, _, h in pages}
    for r in got:
        h = html[r["page_id"]]
        best = owner[h]
        revisit = r["page_id"] is not None and r["page_id"] != best
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (best if revisit else None)
        assert r["payload_bytes"] == len(h.encode()) and r["payload_digest"] == warc.digest(h.encode())
        assert revisit or bytes(r["payload"]) == h.encode()


def test_warc_reader_skips_garbage():
    import zlib

    def member(i):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(warc.record(i, None, b"\x1f\x8b\x08" * 9, "x", None, "d")) + c.flush()

    blob = b"junk\x1f\x8b\x08junk" + member(1) + member(2) + b"\x1f\x8b\x08" + member(3) + member(4)[:-9]
    for step in (7, 50, len(blob)):
        got = [warc.parse(c)["page_id"] for at in range(0, len(blob), step) for c in warc.members(lambda i, n: blob[i : i + n], len(blob), at, min(len(blob), at + step))]
        assert got == [1, 2, 3]


def test_language_held_out_accuracy(spark):
    rows = registered.op10_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def _plain_language(docs, texts):
    """The language whose byte n-grams make the text likeliest, without numpy: counts, logarithms, sums."""
    import math

    def grams(text):
        b = b" " + bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in text.encode()) + b"   "
        for i in range(1, len(b) - 3):
            if b[i] != 32:
                tri = b[i - 1] | b[i] << 8 | b[i + 1] << 16
                yield (tri * 2654435761 % 2**32) >> 17
                yield (((tri | b[i + 2] << 24) * 2246822519 + 374761393) % 2**32 >> 17) + 32768

    counts = defaultdict(Counter)
    for lang, text in docs:
        counts[lang].update(grams(text))
    total = {(x, half): sum(n for g, n in c.items() if (g >= 32768) == half) for x, c in counts.items() for half in (False, True)}
    for text in texts:
        own = list(grams(text))
        yield max(sorted(counts), key=lambda x: sum(math.log((counts[x][g] + 0.5) / (total[x, g >= 32768] + 0.5 * 32768)) for g in own))  # noqa: B023


def test_language_of_plain_texts_by_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    learned = [(r["lang"], r["text"]) for r in docs.filter(~langid.held_out(docs["doc_id"])).collect() if r["lang"] and r["text"]]
    rows = {r["doc_id"]: r["text"][:3000] for r in docs.filter(langid.held_out(docs["doc_id"]) & (F.length("text") > 0)).collect()}
    got = langid.predict(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), langid.train(docs, ~langid.held_out(docs["doc_id"]))).filter("size(langs) = 1").collect()
    assert len(got) > 20
    assert [r["lang_pred"] for r in got] == list(_plain_language(learned, [rows[r["doc_id"]] for r in got]))


def test_language_of_more_labels_than_a_model_holds(spark):
    """Groups of labels choose what one model of all labels chooses, and every label is learned."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    texts = {r["lang"]: r["t"][:1500] for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("t")).collect()}
    odd = [(1000 + i, f"junk{i}", " ".join(f"{chr(97 + (i * k) % 26)}{chr(98 + (i + k) % 24)}q{i}w" for k in range(40))) for i in range(12)]
    mixed = [(2000, None, " ".join(texts.values())), (2001, None, texts["en"] + " " + odd[3][2] * 3), (2002, None, None), (2003, None, "12 34"), (2004, None, "a"), (2005, None, odd[7][2])]
    df = docs.unionByName(spark.createDataFrame([*odd, *mixed], docs.schema))
    whole, parts = langid.train(df, F.lit(True)), langid.train(df, F.lit(True), most_languages=6)
    assert len(whole["langs"]) == len(texts) + 12 and parts["groups"] > 2
    said = lambda model: {r["doc_id"]: (r["lang_pred"], round(r["score"], 4), r["langs"]) for r in langid.predict(df, model).collect()}
    got, want = said(parts), said(whole)
    assert got == want and got[2005][0] == "junk7" and len(got[2000][2]) > 2 and got[2002] == ("und", 0.0, [])
    kept = lambda model: {r["doc_id"] for r in langid.keep_languages(df, model).collect()}
    assert kept(parts) == kept(whole)
    assert langid.predict(df.limit(0), parts).count() == 0


def test_language_slices_give_what_a_whole_text_gives(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.Model(langid.train(docs, F.lit(True)))
    long = {r["lang"]: r["t"] for r in docs.filter("n_chars > 2000").groupBy("lang").agg(F.max("text").alias("t")).collect()}
    text = (long["de"] + " " + long["fr"] + " ") * 3
    whole = model.infer(text)
    monkeypatch.setattr(langid, "SLICE", 500)
    monkeypatch.setattr(langid, "HELD_FLOATS", 1)
    sliced = model.infer(text)
    assert [x for x, _ in sliced[0]] == [x for x, _ in whole[0]] and abs(sliced[1] - whole[1]) < 1e-3
    assert model.is_language(text) and not model.is_language("123 4") and not model.is_language(None)
    rng = random.Random(1)
    assert not model.is_language(" ".join("".join(rng.choice("qxzjvkw") for _ in range(7)) for _ in range(60)))


def test_language_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.Model(langid.train(docs, F.lit(True)))
    long = {r["lang"]: r["t"] for r in docs.filter("n_chars > 2000").groupBy("lang").agg(F.max("text").alias("t")).collect()}
    found = dict(model.mixture(long["de"][:1500] + " " + long["fr"][:1500]))
    assert set(found) == {"de", "fr"} and abs(found["de"] - 0.5) < 0.2
    assert model.mixture("123 ... 45") == []
