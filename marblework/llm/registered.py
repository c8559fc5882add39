"""The queries of the operators, ``opN_<name>``, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marblework.llm import bpe, chat, decontam, langid, licenses, near_dup, periodic, quality, secrets, substring, suffix, trie, warc
from marblework.llm.common import digest_text, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.pack_trees(given.unionByName(own)))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_units(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(_table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return warc.read(manifest, with_payload=False).drop("url")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, ~langid.held_out(docs["doc_id"]))
    return langid.predict(docs, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _crc32(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations (as ``trie.gather`` gives them) whose first h turns are those of conversation c - c % 100; h = crc32(c) % 6."""
    heads = convs.select(F.col("conv_id").alias("head_id"), F.col("turns").alias("head"))
    h = (_crc32(F.col("conv_id")) % 6).cast("int")
    own = convs.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % 100).withColumn("h", h)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    first = F.slice(F.coalesce("head", F.array().cast(trie.TURNS)), F.lit(1), F.col("h"))
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(rebuilt(trie.gather(_table(spark, sf_dir, "conversations"))))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; where crc32(doc_id) % 10 is 0 the words from a on become a repetition of p words from there."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = _crc32(F.col("doc_id"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("words").cast("long")
    placed = chosen.withColumn("a", F.when(n > 0, F.expr("g % nullif(size(words), 0)"))).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    i = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))
    made = F.array_join(F.transform("words", lambda w, k: F.get("words", i(k).cast("int"))), " ")
    return placed.select("doc_id", F.when(F.col("p").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.scan(with_planted_runs(_table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest_text(periodic.listed(F.col("runs"))).alias("runs_sha256"), digest_text(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


QUERIES = {f.__name__: f for f in (op1_chat_tree, op2_near_dedup, op3_bpe, op4_decontaminate, op5_substring_dedup, op6_quality, op7_secrets, op8_suffix_dedup, op9_warc, op10_language, op11_prefix_trie, op12_periodic_runs, op13_license_scan)}

#: CRC-32 of the decimal ``{0}``, bit by bit.
_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST({0} AS VARCHAR), i, 1)) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""


def _license_sql() -> str:
    """Base phrases word by word; notices by counting, at each of a template's words, those within its length."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    kinds = ", ".join(f"({t['template']}, '{t['label']}', {str(t['phrase']).lower()}, {quoted(t['row'])}, {quoted(t['words'])}, {t['need']})" for t in licenses.templates())
    return rf"""
WITH k(template, label, phrase, r, words, need) AS (VALUES {kinds}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN k ON phrase AND w[i : i + len(r) - 1] = r GROUP BY doc_id),
h AS (SELECT doc_id, i, word, template FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d) JOIN (SELECT template, unnest(words) AS word FROM k WHERE NOT phrase) USING (word)),
met AS (
  SELECT doc_id, template, max(n) AS n FROM (
    SELECT x.doc_id, x.template, x.i, count(DISTINCT y.word) AS n FROM h x JOIN k USING (template) JOIN h y ON x.doc_id = y.doc_id AND x.template = y.template AND y.i >= x.i AND y.i < x.i + len(r) GROUP BY 1, 2, 3)
  JOIN k USING (template) WHERE n >= need GROUP BY 1, 2),
more AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM (
    SELECT doc_id, label, n / len(words) AS share FROM met JOIN k USING (template)
    UNION ALL SELECT doc_id, unnest(string_split(base_labels, ',')), 1.0 FROM base) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""


SQL = {
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % 100 AS head_id, {_SQL_CRC.format("conv_id")} % 6 AS h FROM t),
b AS (SELECT h.conv_id, list_concat(coalesce(x.turns[1 : h.h], []), h.turns[h.h + 1 :]) AS turns FROM h LEFT JOIN t x ON x.conv_id = head_id),
p AS (SELECT conv_id, d, turns[1 : d] AS k, len(turns) AS n FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM b)),
node AS (
  SELECT k, d, min(conv_id) AS c, count(*) AS n, coalesce(length(k[-1].t), 0) AS chars,
    sha256(coalesce(string_agg(CASE WHEN p.n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY k, d),
member AS (SELECT conv_id, d, c FROM p JOIN node USING (k, d)),
tree AS (SELECT node.c, node.d, node.n, chars, ends_sha256, m.c AS parent FROM node LEFT JOIN member m ON m.conv_id = node.c AND m.d = node.d - 1),
kids AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM tree WHERE d > 0 GROUP BY 1, 2),
full_tree AS (SELECT tree.*, coalesce(n_children, 0) AS n_children FROM tree LEFT JOIN kids ON kids.parent = tree.c AND kids.d = tree.d),
under AS (
  SELECT m.c, m.d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n - 1) * chars) AS BIGINT) AS saved_tokens
  FROM full_tree x JOIN member m ON m.conv_id = x.c AND m.d <= x.d GROUP BY 1, 2)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM full_tree JOIN under USING (c, d)""",
    "op12_periodic_runs": rf"""
WITH o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_SQL_CRC.format("doc_id")} AS h FROM documents),
g AS (SELECT *, len(w) AS n, h // 10 AS g FROM o),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g),
pl AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM pl),
word AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM d),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS m FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT doc_id, s, m, min(q) AS q FROM stretch GROUP BY doc_id, s, m),
summed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
    first({{'s': s, 'm': m, 'q': q}} ORDER BY m / q DESC, s, q) AS best FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.m AS length, best.q AS period, 1000 * best.m // best.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_license_scan": _license_sql(),
    "op1_chat_tree": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS e,
             replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS r FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(e) + length(r) + 14) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""",
    "op2_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: hash(w[i : i + least(5, len(w)) - 1]))) AS g FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT l.b, reach.r FROM reach JOIN link l ON l.a = reach.a),
least_one AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least_one l ON l.doc_id = d.doc_id""",
    "op4_decontaminate": r"""
WITH dw AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, w[i : i + least(13, len(w)) - 1] AS g FROM (
    SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
found AS (
  SELECT doc_id, i, x.m, item_id FROM (SELECT doc_id, i, m, w[i : i + m - 1] AS g FROM dw, lengths WHERE i + m - 1 <= len(w)) x JOIN windows y ON x.m = y.m AND x.g = y.g),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
n AS (SELECT doc_id, len(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n_words FROM documents)
SELECT doc_id, n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n_words AS contaminated
FROM n LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw, sha1(encode(coalesce(html, ''))) AS h FROM pages),
m AS (SELECT page_id, octet_length(raw) AS payload_bytes, h, max(page_id) OVER (PARTITION BY h) AS owner FROM p),
bits AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), 'string_agg', '') AS b FROM m)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * CAST(substr(b, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INTEGER) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INTEGER)
    + 2 * CAST(substr(b, 5 * i + 4, 1) AS INTEGER) + CAST(substr(b, 5 * i + 5, 1) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM bits""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
