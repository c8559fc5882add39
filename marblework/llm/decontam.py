"""Benchmark decontamination by Wu-Manber search over words.

Item texts become windows of ``width`` words; a shorter item is one window.
Windows of one length form a matcher: a shift table over blocks of two words
says how far the search may jump, a window's last block picks its bucket, and
only the bucket's windows are compared word by word.  Text is read in jumps of
up to ``width - 1`` words.

Tasks build the matchers themselves, from a benchmark of at most ``chunk_bytes``
of text; the driver only passes it on.  A larger benchmark stays distributed, and
documents are still read once: the shift table becomes one of at most SLOTS bytes
by hashed blocks, in which blocks that fall together take the lesser shift.  Where
it says 0 and a bitmap of at most BITS bits knows the window's hash, the window is
a candidate.  Candidates join the benchmark's windows by hash and are compared
word for word.  A fuller table or bitmap makes more candidates and changes no
result.

Null or wordless texts have no words and no hits; a null or wordless item has no
windows.  Repeated items each count, by item_id; one window of several items
marks all of them; the words of an item with a null id are hit, and no item is
named.  Repeated rows each get their own row.  Empty documents give
an empty result, an empty benchmark gives rows without hits.  Columns besides
those named are not read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, filter_rows, map_rows, pieces, release, ship, unused

#: Bytes of the shift table and bits of the bitmap of a large benchmark, at most; powers of two.
SLOTS, BITS = 1 << 24, 1 << 29
#: Entries of a table that travel as one row.
_PAGE = 1 << 16

#: Lower-cases A-Z and blanks every ASCII byte that is neither digit nor letter; other bytes stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Matcher:
    """Wu-Manber over the windows of one length of items (name, words), which are held as one list of words."""

    def __init__(self, length: int, items: list[tuple[str | None, list[bytes]]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        self.flat: list[bytes] = []
        self.starts, self.names = [], []
        #: Further items of a window, by its first place.
        self.more: dict[int, set[str]] = defaultdict(set)
        one: dict[bytes, bytes] = {}
        seen: dict[int, int] = {}
        flat, m = self.flat, length
        for name, words in items:
            base = len(flat)
            self.starts.append(base)
            self.names.append(name)
            flat += [one.setdefault(w, w) for w in words]
            for at in range(base, len(flat) - m + 1):
                window = flat[at : at + m]
                known = seen.setdefault(hash(tuple(window)), at)
                if known != at and flat[known : known + m] == window:
                    if name is not None:
                        self.more[known].add(name)
                    continue
                for end in range(self.block, m + 1):
                    key = tuple(window[end - 2 : end]) if self.block == 2 else window[end - 1]
                    self.shift[key] = min(self.shift.get(key, self.far), m - end)
                self.bucket[key].append(at)

    def search(self, words: list[bytes], hit: np.ndarray, found: set[str]) -> None:
        """Marks the words inside occurrences in ``hit`` and adds the items to ``found``."""
        m, n, far, shift, bucket, flat = self.length, len(words), self.far, self.shift.get, self.bucket, self.flat
        i, two = m - 1, self.block == 2
        while i < n:
            key = (words[i - 1], words[i]) if two else words[i]
            step = shift(key, far)
            if step:
                i += step
                continue
            at = i - m + 1
            for start in bucket.get(key, ()):
                if flat[start] == words[at] and flat[start : start + m] == words[at : i + 1]:
                    hit[at : i + 1] = True
                    if (name := self.names[bisect_right(self.starts, start) - 1]) is not None:
                        found.add(name)
                    if start in self.more:
                        found |= self.more[start]
            i += 1


def matchers(items: list[tuple[str | None, str | None]], width: int) -> list[Matcher]:
    by_length: dict[int, list] = defaultdict(list)
    for name, text in items:
        if words := words_of(text):
            by_length[min(width, len(words))].append((name, words))
    return [Matcher(m, of) for m, of in by_length.items()]


def _items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    return benchmark.select(benchmark[item_column].cast("string").alias("name"), benchmark[text_column].alias("text")).filter("text IS NOT NULL")


def _is_small(items: DataFrame, limit: int) -> bool:
    return (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= limit


def _handed(items: DataFrame) -> list[tuple[str | None, str]]:
    """The items of a benchmark whose size has been looked at."""
    return [(r["name"], r["text"]) for r in items.collect()]


#: The matchers that a Python worker has built, of one chunk at a time.
_BUILT: dict[str, list[Matcher]] = {}


def _searcher(df: DataFrame, items: list, width: int):
    """(broadcast, function of a text for tasks: its number of words, the hit ones, the items found)."""
    held, key = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def search(text: str | None) -> tuple[int, np.ndarray, list[str]]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = matchers(held.value, width)
        words, found = words_of(text), set()
        hit = np.zeros(len(words), bool)
        for m in _BUILT[key]:
            m.search(words, hit, found)
        return len(words), hit, sorted(found)

    return held, search


class _Words(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


_HASH = _Words()
_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hashes of ``width`` neighbouring words."""
    n = max(0, len(h) - width + 1)
    roll = np.full(n, seed, np.uint64)
    for i in range(width):
        roll = _mixed(roll * _M + h[i : i + n])
    return roll


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


def _blocks(h: np.ndarray, m: int) -> np.ndarray:
    """Of windows of m words: a hash of the block that ends at each word from the block's last on."""
    return _rolled(h, min(2, m), 1000 + m)


def _paged(df: DataFrame, size: int, fill: int, combine) -> bytes:
    """A table of ``size`` entries as bytes, put together page by page from rows (at, value) in tasks."""
    page = F.shiftright("at", int(np.log2(_PAGE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at, value = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(at >> 16, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order] >> 16)) + 1
            for some in np.split(order, cuts) if len(order) else ():
                n = int(at[some[0]] >> 16)
                if n not in held:
                    held[n] = np.full(_PAGE, fill, np.uint8)
                combine.at(held[n], at[some] & (_PAGE - 1), value[some].astype(np.uint8))
        for n, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["page", "entries"])

    out = np.full(size, fill, np.uint8)
    for r in df.select("at", "value").repartition(page).mapInArrow(run, "page long, entries binary").toLocalIterator():
        part = out[r["page"] * _PAGE : (r["page"] + 1) * _PAGE]
        part[:] = np.frombuffer(r["entries"], np.uint8)[: len(part)]
    return out.tobytes()


def _power(n: int, least: int, most: int) -> int:
    return min(most, max(least, 1 << max(0, int(n - 1).bit_length())))


def _by_hashes(rows: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(_row, n_words, n_hit, items) of ``rows`` (_row, _text), which are written, by one pass over them."""
    ship(rows.sparkSession)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, lengths, hashes, texts = [], [], [], []
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                m = min(width, len(words))
                if m:
                    n = len(words) - m + 1
                    names += [name] * n
                    lengths += [m] * n
                    hashes.append(_rolled(_hashes(words), m, m).view(np.int64))
                    texts += [b" ".join(words[i : i + m]) for i in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int32()), pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64)), pa.array(texts, pa.binary())], names=["name", "m", "hash", "window"])

    def shifts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at, value = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                m = min(width, len(words))
                if m:
                    blocks = _blocks(_hashes(words), m)
                    ends = np.arange(len(blocks)) + min(2, m)
                    at.append((blocks & np.uint64(slots - 1)).astype(np.int64))
                    value.append(m - np.minimum(m, ends))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (at, value)], names=["at", "value"])

    known = cut(items.mapInArrow(windows, "name string, m int, hash long, window binary").distinct())
    total, lengths = known.agg(F.count("*"), F.collect_set("m")).first()
    slots, bits = _power(8 * total, _PAGE, SLOTS), _power(32 * total, 8 * _PAGE, BITS)
    table = _paged(items.mapInArrow(shifts, "at long, value long").groupBy("at").agg(F.min("value").alias("value")), slots, 255, np.minimum)
    bit = F.pmod(F.col("hash"), F.lit(bits))
    bitmap = _paged(known.select(F.shiftright(bit, 3).alias("at"), F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("long").alias("value")).distinct(), bits // 8, 0, np.bitwise_or)
    held = rows.sparkSession.sparkContext.broadcast((table, bitmap))
    lengths = sorted(lengths)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, bitmap = (np.frombuffer(x, np.uint8) for x in held.value)
        for batch in pieces(batches):
            counts, found = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                h, own = _hashes(words), []
                for m in lengths:
                    if m > len(words):
                        continue
                    first = min(2, m)
                    far = m - first + 1
                    steps = np.minimum(shift[_blocks(h, m) & np.uint64(slots - 1)], far).tolist()
                    whole = _rolled(h, m, m).view(np.int64)
                    i = m - 1
                    while i < len(words):
                        if step := steps[i - first + 1]:
                            i += step
                            continue
                        at = i - m + 1
                        b = int(whole[at]) % bits
                        if bitmap[b >> 3] >> (b & 7) & 1:
                            own.append({"at": at, "m": m, "hash": int(whole[at]), "window": b" ".join(words[at : i + 1])})
                        i += 1
                counts.append(len(words))
                found.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.struct([("at", pa.int64()), ("m", pa.int32()), ("hash", pa.int64()), ("window", pa.binary())])))], names=["_row", "n_words", "found"])

    searched = cut(rows.select("_row", "_text").mapInArrow(search, "_row long, n_words long, found array<struct<at: long, m: int, hash: long, window: binary>>"))
    # written, so that the join's sides are plain exchanges and Spark can split a window that very many documents hold
    single = cut(known.select(F.col("m").alias("_m"), F.col("hash").alias("_hash"), F.col("window").alias("_window")).distinct())
    met = searched.select("_row", F.explode("found").alias("x")).select("_row", "x.*").join(single, (F.col("hash") == F.col("_hash")) & (F.col("m") == F.col("_m")) & (F.col("window") == F.col("_window")))
    sure = cut(met.select("_row", "at", "m", "hash"))
    spans = F.array_sort(F.collect_list(F.struct(F.col("at").alias("_from"), (F.col("at") + F.col("m")).alias("_to"))))
    covered = F.aggregate(
        "_s",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), x["_to"] - F.greatest(x["_from"], a["end"]))).alias("n"), F.greatest(a["end"], x["_to"]).alias("end")),
    )["n"]
    hits = sure.groupBy("_row").agg(spans.alias("_s")).select("_row", covered.alias("n_hit"))
    named = sure.select("_row", "m", "hash").distinct().join(known.filter("name IS NOT NULL").select("m", "hash", "name").distinct(), ["m", "hash"])
    lists = named.groupBy("_row").agg(F.array_sort(F.collect_set("name")).alias("items"))
    none = F.array().cast("array<string>")
    out = cut(searched.select("_row", "n_words").join(hits, "_row", "left").join(lists, "_row", "left").select("_row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items")))
    held.destroy()
    release(known, searched, single, sure)
    return out


def _contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def find(
    df: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    chunk_bytes: int = 8_000_000,
) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items (sorted as strings), contaminated.

    With a small benchmark nothing is shuffled; with a large one, only windows
    that may be of it, and a row of figures per document.
    """
    asked = _items(benchmark, item_column, item_text_column)
    if _is_small(asked, chunk_bytes):
        _, search = _searcher(df, _handed(asked), width)

        def row(text: str | None) -> list:
            n, hit, found = search(text)
            return [n, int(hit.sum()), len(found), found]

        got = map_rows(df, [id_column, text_column], "n_words long, n_hit long, n_items long, items array<string>", row)
    else:
        rows = cut(df.select(df[id_column].alias("_id"), df[text_column].alias("_text"), F.monotonically_increasing_id().alias("_row")))
        hits = _by_hashes(rows, asked, width)
        found = rows.select("_id", "_row").join(hits, "_row")
        got = cut(found.select(F.col("_id").alias(id_column), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items"))
        release(rows, hits)
    return got.withColumn("contaminated", _contaminated())


def keep_clean(df: DataFrame, benchmark: DataFrame, width: int = 13, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", chunk_bytes: int = 8_000_000) -> DataFrame:
    """All columns of the rows that are not contaminated.

    With a small benchmark a row is judged where it stands; with a large one, rows
    are numbered and written once and the contaminated numbers are taken out.
    """
    asked = _items(benchmark, item_column, item_text_column)
    if _is_small(asked, chunk_bytes):
        _, search = _searcher(df, _handed(asked), width)

        def keep(text: str | None) -> bool:
            n, hit, _ = search(text)
            hits = int(hit.sum())
            return not (hits > 0 and 20 * hits >= n)

        return filter_rows(df, text_column, keep)
    number = unused(df, "_row")
    rows = cut(df.withColumn(number, F.monotonically_increasing_id()))
    bad = _by_hashes(rows.select(F.col(number).alias("_row"), F.col(text_column).alias("_text")), asked, width).filter(_contaminated()).select(F.col("_row").alias(number))
    return rows.join(bad, number, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``find``'s rows with the items as one SHA-256 in place of the list."""
    return found.select(id_column, "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
