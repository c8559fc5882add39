"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

A byte is removed if a string of ``window`` bytes that covers it also starts
elsewhere.  Beside it, bytes of repeated strings of ``report`` bytes are counted,
so that shorter shared passages show too.  The suffix array is sparse: every
string of ``report`` bytes has one anchor, the leftmost of its ``core``-byte grams
with the least hash, so equal strings have their anchors at equal places, and
only suffixes from anchors are sorted.

1. Texts with equal SHA-256 are one unit; units of several rows repeat whole.
   Anchors whose gram occurs once in all units match nothing and drop out.
2. Tasks sort the contexts of the other anchors into runs, once by (key, suffix)
   and once by (key, reversed prefix), front-coded: each entry holds the length
   of the prefix that it shares with the one before it and the rest.  The key is
   the gram's hash.  Entries with equal contexts collapse in the task that makes
   them; further places of such a context are known to repeat and travel apart,
   dealt evenly.
3. Runs are exchanged by key.  A task merges both kinds of runs with loser trees
   whose players know the prefix that they share with the last winner, so no
   known prefix is compared again; the merges give the prefixes that neighbours
   share.
4. A string of W bytes that starts ``a`` bytes before its anchor repeats if another
   entry shares ``a`` bytes leftwards and ``W - a`` bytes rightwards.  Shared
   prefixes of both sorted sides cut entries into classes for each ``a``; two
   entries of one class pair repeat.

Memory of a merging task is bounded: the number of tasks follows from the bytes
of the contexts, and a gram with more than ``split_over`` places is not one key
but many: its starts ``a`` are cut into pieces of PIECE, each keyed by the bytes
that all strings of the piece must share; a piece that still has more places is
cut into single starts, whose equal strings collapse where they are made.

A stretch of period q <= SHORT_PERIOD with q bytes more than a window repeats
itself, all of it: it is one span at once.  Of the strings inside it only those of
the first q starts are listed, which are all that there are, so that other
places with one of them still meet it.

Null and empty texts, and texts shorter than the window, lose nothing.
Repeated rows repeat each other.  Ties cannot change the result: all
occurrences are removed.  An empty table gives an empty one.  Ids may repeat.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, pieces, release, ship

SLICE = 1 << 19
_BITS = 20
_LOW = np.uint64((1 << _BITS) - 1)
#: Bytes of contexts that a task gathers before it sorts and sends them as runs.
RUN_BYTES = 12 << 20
#: Bytes of contexts for one merging task.
MERGE_BYTES = 64 << 20
#: Starts of strings that share a key of a gram with very many places.
PIECE = 16
#: Periods of stretches that are taken out before anchors are listed, at most.
SHORT_PERIOD = 128
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def gram_hashes(b: np.ndarray, core: int) -> np.ndarray:
    """A mixed 64-bit hash of each ``core``-byte gram, by prefix sums of a polynomial."""
    n = len(b)
    up, down = _powers(SLICE + (1 << 12))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    x = (sums[core:] - sums[: n + 1 - core]) * down[: n + 1 - core]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def stretches(raw: bytes, windows: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """(start, end, period) of stretches of a short period with the longest window's bytes and a period at least, in order, none over another.

    A period is no longer than any window, so the repeated strings cover a stretch
    without gaps.  Such a stretch has a place among every ``window // 2`` where eight bytes come
    again after its period; places inside a stretch already found are passed over.
    """
    window, longest = windows[0], min(SHORT_PERIOD, windows[-1])
    step, found, n = max(1, window // 2), [], len(raw)
    if n <= window + 8:
        return found
    words = np.ndarray((n - 7,), "<u8", raw, strides=(1,))
    b, at = np.frombuffer(raw, np.uint8), np.arange(0, n - 7, step)
    covered, taken = np.zeros(len(at), bool), np.zeros(len(at), bool)
    periods = np.arange(1, min(longest, n - window) + 1)[:, None]
    for first in range(0, len(at), 4096):
        some = at[first : first + 4096]
        again = some + periods
        same = (words[np.minimum(again, len(words) - 1)] == words[some]) & (again < len(words))
        for q, k in np.argwhere(same).tolist():  # least periods first
            q, k = q + 1, k + first
            if covered[k]:
                continue
            start, end = _stretch(b, int(at[k]), q)
            inside = slice(-(-start // step), max(0, end - 8) // step + 1)
            if end - start >= window + q and not taken[inside].any():
                found.append((start, end, q))
                taken[inside] = True
                covered[inside.start : max(0, end - 8 - q) // step + 1] = True
    return sorted(found)


def _stretch(b: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The largest stretch around ``at`` in which bytes ``q`` apart are equal."""
    left = right = at
    step = 64
    while right + q < len(b):
        end = min(right + step, len(b) - q)
        differ = np.flatnonzero(b[right:end] != b[right + q : end + q])
        if len(differ):
            right += int(differ[0])
            break
        right, step = end, 2 * step
    step = 64
    while left > 0:
        begin = max(left - step, 0)
        differ = np.flatnonzero(b[begin:left] != b[begin + q : left + q])
        if len(differ):
            left = begin + int(differ[-1]) + 1
            break
        left, step = begin, 2 * step
    return left, right + q


def listed(raw: bytes, windows: tuple[int, ...], core: int, own: list[tuple[int, int, int]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors, without starts of strings that stretches of a short period hold again from their first period."""
    place, key, first, last = anchors(raw, windows[-1], core)
    keep = np.ones(len(place), bool)
    for start, end, q in stretches(raw, windows) if own is None else own:
        low, high = start + q, end - windows[0]
        over = slice(int(np.searchsorted(last, low)), int(np.searchsorted(first, high, "right")))
        f, x = first[over], last[over]
        keep[over] &= (f < low) | (x > high)
        head, tail = (f < low) & (x <= high), (f >= low) & (x > high)
        x[head], f[tail] = low - 1, high + 1
    return place[keep], key[keep], first[keep], last[keep]


def anchors(raw: bytes, window: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, gram hash, first start, last start) of each anchor; each start of a window has one."""
    wide, found = window - core + 1, []
    whole = np.frombuffer(raw, np.uint8)
    for at in range(0, len(raw) - window + 1, SLICE):
        b = whole[at : at + SLICE + window - 1]
        h = gram_hashes(b, core)
        # the place below the hash's high bits: the least is the leftmost of the least hashes
        v = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(v) // wide)
        grid = np.full(rows * wide, ~np.uint64(0), np.uint64)
        grid[: len(v)] = v
        grid = grid.reshape(rows, wide)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(b) - window + 1
        p = (np.minimum(behind[:starts], ahead[wide - 1 : wide - 1 + starts]) & _LOW).astype(np.int64)
        edge = np.flatnonzero(np.diff(p)) + 1
        first = np.concatenate([[0], edge])
        last = np.concatenate([edge, [starts]]) - 1
        place = p[first]
        # least hashes lie low: mixed again, they spread evenly over the merging tasks
        found.append((place + at, h[place] * np.uint64(_BASE), first + at, last + at))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def shared(a: bytes, b: bytes, at: int) -> int:
    """The length of the common prefix, of which ``at`` bytes are known."""
    n, step = min(len(a), len(b)), 8
    while at < n and a[at : at + step] == b[at : at + step]:
        at, step = at + step, step * 2
    if at >= n:
        return n
    while step > 1:
        step //= 2
        if a[at : at + step] == b[at : at + step]:
            at += step
    return min(at, n)


def front_code(sorted_strings: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """(shared lengths, joined rests, lengths of the rests)."""
    before, lcp, rest = b"", [], []
    for s in sorted_strings:
        k = shared(before, s, 0)
        lcp.append(k)
        rest.append(s[k:])
        before = s
    return np.array(lcp, np.uint16), b"".join(rest), np.array([len(r) for r in rest], np.uint16)


def front_decode(lcp: np.ndarray, rests: bytes, lengths: np.ndarray) -> Iterator[bytes]:
    before, at = b"", 0
    for k, n in zip(lcp.tolist(), lengths.tolist(), strict=True):
        before = before[:k] + rests[at : at + n]
        at += n
        yield before


class LoserTree:
    """Merges sorted runs of (string, shared length with the one before in its run, payload).

    Each loser keeps the length of the prefix that it shares with the winner of
    its match.  When two players meet whose shared lengths with the last overall
    winner differ, the longer one is less; only for equal lengths are bytes
    compared, from that length on.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.n = 1
        while self.n < max(1, len(runs)):
            self.n *= 2
        self.player = [next(r, None) for r in runs] + [None] * (self.n - len(runs))
        self.lcp = [0] * self.n
        self.loser = [0] * self.n
        self.winner = self._build(1)

    def _match(self, x: int, y: int) -> tuple[int, int]:
        """(winner, loser)."""
        a, b = self.player[x], self.player[y]
        if b is None:
            return x, y
        if a is None:
            return y, x
        k, m = self.lcp[x], self.lcp[y]
        if k > m:
            return x, y
        if m > k:
            return y, x
        s, t = a[0], b[0]
        k = shared(s, t, k)
        if s[k : k + 1] <= t[k : k + 1]:
            self.lcp[y] = k
            return x, y
        self.lcp[x] = k
        return y, x

    def _build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        w, self.loser[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return w

    def __iter__(self) -> Iterator[tuple[bytes, int, object]]:
        """(string, shared length with the one before, payload) in order."""
        while (top := self.player[self.winner]) is not None:
            w = self.winner
            yield top[0], self.lcp[w], top[2]
            self.player[w] = new = next(self.runs[w], None)
            self.lcp[w] = new[1] if new else 0
            node = (w + self.n) // 2
            while node:
                w, self.loser[node] = self._match(w, self.loser[node])
                node //= 2
            self.winner = w


def _pieces(raw: bytes, p: int, h: int, low: int, high: int, window: int, step: int) -> Iterator[tuple[int, int, int]]:
    """(key, least a, most a) of the starts before the anchor ``p``, ``step`` at a time.

    The key covers what strings of any start of the piece share if they are equal.
    """
    low = max(low, p + window - len(raw))
    for base in range(low // step * step, high + 1, step):
        least, most = max(low, base), min(high, base + step - 1)
        if least <= most:
            same = raw[p - base : p + window - base - step + 1]
            yield xxhash.xxh3_64_intdigest(b"%d %d %d %d " % (h, window, step, base) + same), least, most


def _contexts(raw: bytes, hot: set[int], fine: set[int], heavy: set[int], windows: tuple[int, ...], core: int) -> Iterator[tuple]:
    """(key, right, left reversed, least a, most a, which window, place) of the anchors at the ``hot`` and ``fine`` places.

    ``which`` is 0 for an entry that serves all windows.
    """
    for p, h, first, last in zip(*(x.tolist() for x in listed(raw, windows, core)), strict=True):
        if p in fine:
            for which, window in enumerate(windows, 1):
                for key, low, high in _pieces(raw, p, h, p - last, p - first, window, PIECE):
                    if np.uint64(key).astype(np.int64) in heavy:
                        for one, a, _ in _pieces(raw, p, h, low, high, window, 1):
                            yield one, raw[p : p - a + window], raw[p - a : p][::-1], a, a, which, p
                    else:
                        yield key, raw[p : p - low + window], raw[p - high : p][::-1], low, high, which, p
        elif p in hot:
            yield h, raw[p : last + windows[0]], raw[first:p][::-1], p - last, p - first, 0, p


def _spans_of(p: int, low: int, high: int, size: int, which: int, windows: tuple[int, ...]) -> Iterator[tuple[int, int, int]]:
    """(window's place, start, end) of a place whose whole context is known to repeat; ``size`` is its right side's length."""
    for i, window in enumerate(windows):
        least = max(low, window - size)
        if which in (0, i + 1) and least <= high:
            yield i, p - high, p - least + window


def _runs(entries: list[tuple], parts: int, windows: tuple[int, ...]) -> Iterator[tuple[int, bytes]]:
    """(part, packed run) of sorted entries (key, right, left, least a, most a, which, place, unit)."""
    entries.sort(key=lambda e: e[:6])
    kept, twice, known = [], [], []
    for e in entries:
        if kept and kept[-1][:6] == e[:6]:
            twice[-1] = True
            known += [(e[7], *x) for x in _spans_of(e[6], e[3], e[4], len(e[1]), e[5], windows)]
        else:
            kept.append(e)
            twice.append(False)
    part = [e[0] * parts >> 64 for e in kept]
    ends = [0, *(i for i in range(1, len(kept)) if part[i] != part[i - 1]), len(kept)]
    for a, b in zip(ends, ends[1:], strict=False):
        if a < b:
            of = kept[a:b]
            keys = [e[0].to_bytes(8, "big") for e in of]
            lefts = sorted((k + e[2], i) for i, (k, e) in enumerate(zip(keys, of, strict=True)))
            units = sorted({e[7] for e in of})
            number = {u: i for i, u in enumerate(units)}
            fields = np.array([(e[3], e[4], e[5], e[6], len(e[1]), number[e[7]], t) for e, t in zip(of, twice[a:b], strict=True)], np.int64)
            run = (front_code([k + e[1] for k, e in zip(keys, of, strict=True)]), front_code([x for x, _ in lefts]), np.array([i for _, i in lefts], np.int32), fields, units)
            yield part[a], pickle.dumps((run, None), pickle.HIGHEST_PROTOCOL)
    for i in range(0, len(known), 20_000):
        yield (i // 20_000 * 7919 + len(kept)) % parts, pickle.dumps((None, known[i : i + 20_000]), pickle.HIGHEST_PROTOCOL)


def _opened(coded: tuple, numbers) -> Iterator[tuple[bytes, int, int]]:
    """A run of a loser tree: the strings, what each shares with the one before, and its entry's number."""
    return zip(front_decode(*coded), coded[0].tolist(), numbers, strict=True)


class _Merge:
    """Merges runs on both sides and finds the repeats, some 20,000 entries of whole keys at a time."""

    def __init__(self, runs: list[tuple], windows: tuple[int, ...]):
        self.windows, start = windows, np.cumsum([0, *(len(r[3]) for r in runs)]).tolist()
        self.fields = np.concatenate([r[3] for r in runs]) if runs else np.zeros((0, 7), np.int64)
        self.units = [r[4] for r in runs]
        self.run_of = np.repeat(np.arange(len(runs)), [len(r[3]) for r in runs])
        self.place = np.zeros(start[-1], np.int64)
        self.right = LoserTree([_opened(r[0], range(n, n + len(r[3]))) for n, r in zip(start, runs, strict=False)])
        self.left = iter(LoserTree([_opened(r[1], (r[2] + n).tolist()) for n, r in zip(start, runs, strict=False)]))

    def __iter__(self) -> Iterator[tuple[bytes, int, int, int]]:
        """(unit, window's place, start, end)."""
        held = []
        for _, k, number in self.right:
            if k < 8 and len(held) > 20_000:
                yield from self._repeated(held)
                held = []
            held.append((k, number))
        if held:
            yield from self._repeated(held)

    def _repeated(self, held: list[tuple[int, int]]) -> Iterator[tuple[bytes, int, int, int]]:
        n = len(held)
        number = np.array([x for _, x in held], np.int64)
        self.place[number] = np.arange(n)
        # the left sides of the same keys come in the same order of keys
        beside = [(k, x) for _, (_, k, x) in zip(range(n), self.left, strict=False)]
        order = self.place[np.array([x for _, x in beside], np.int64)]
        lcp_r, lcp_l = (np.maximum(np.array([k for k, _ in of], np.int64) - 8, -1) for of in (held, beside))
        lcp_r[0] = lcp_l[0] = -1
        low, high, which, at, size, unit, twice = self.fields[number].T
        whole = twice > 0
        reach = lambda lcp: np.maximum(lcp, np.append(lcp[1:], -1))
        most_r, most_l = reach(lcp_r), np.empty(n, np.int64)
        most_l[order] = reach(lcp_l)
        named = lambda i: self.units[self.run_of[number[i]]][unit[i]]
        for i in np.flatnonzero(whole).tolist():
            for x in _spans_of(int(at[i]), int(low[i]), int(high[i]), int(size[i]), int(which[i]), self.windows):
                yield named(i), *x
        class_l = np.empty(n, np.int64)
        for w, window in enumerate(self.windows):
            first, final = np.maximum(low, window - most_r), np.minimum(high, most_l)
            open_ = np.flatnonzero((first <= final) & (most_r >= 0) & (most_l >= 0) & ((which == 0) | (which == w + 1)))
            found: dict[int, list[int]] = {}
            for a in range(int(first[open_].min()), int(final[open_].max()) + 1) if len(open_) else ():
                some = open_[(first[open_] <= a) & (a <= final[open_])]
                if len(some) < 2:
                    continue
                class_r = np.cumsum(lcp_r < window - a)
                class_l[order] = np.cumsum(lcp_l < a)
                _, back, times = np.unique(class_r[some] * (n + 1) + class_l[some], return_inverse=True, return_counts=True)
                for i in some[(times[back] > 1) & ~whole[some]].tolist():
                    found.setdefault(i, []).append(a)
            for i, starts in found.items():
                cuts = [0, *(j for j in range(1, len(starts)) if starts[j] != starts[j - 1] + 1), len(starts)]
                for x, y in zip(cuts, cuts[1:], strict=False):
                    yield named(i), w, int(at[i]) - starts[y - 1], int(at[i]) - starts[x] + window


def _over(df: DataFrame, limit: int) -> DataFrame:
    """(key, n) of the keys with more than ``limit`` rows, written so that both sides of a join by key are plain exchanges that Spark can split."""
    return cut(df.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > limit))


def removed_spans(df: DataFrame, windows: tuple[int, ...] = (400, 256), core: int = 128, split_over: int = 1 << 16, text_column: str = "text") -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(units, spans, steps): per unit its texts' SHA-256, rows and bytes; per unit with repeats its text and spans (w, start, end).

    ``windows`` fall, and ``w`` is a window's place among them.  ``steps`` are the
    written tables that both rest on, to be released when both have been used.
    """
    session, shortest = df.sparkSession, windows[-1]
    ship(session)
    span_type = pa.list_(pa.struct([("w", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    raws = df.select(F.coalesce(df[text_column], F.lit("")).cast("binary").alias("raw")).withColumn("unit", F.unhex(F.sha2("raw", 256)))

    def lists(found: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, own = [], []
            for raw in batch.column(1).to_pylist():
                whole = stretches(raw, windows)
                found.append(listed(raw, windows, core, whole))
                own.append([{"w": w, "start": a, "end": b} for a, b, _ in whole for w in range(len(windows))])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists([x[0] for x in found]), lists([x[1].view(np.int64) for x in found]), pa.array(own, span_type)], names=["unit", "places", "keys", "own"])

    def mark_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys = []
            for raw, fine in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                fine, own = set(fine), []
                for p, h, first, last in zip(*(x.tolist() for x in listed(raw, windows, core)), strict=True):
                    if p in fine:
                        own += [key for w in windows for key, _, _ in _pieces(raw, p, h, p - last, p - first, w, PIECE)]
                keys.append(np.array(own, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(keys)], names=["unit", "keys"])

    long_enough = raws.filter(F.length("raw") >= shortest)
    spans_of = "array<struct<w: int, start: long, end: long>>"
    marked = long_enough.select("unit", "raw").mapInArrow(mark, f"unit binary, places array<long>, keys array<long>, own {spans_of}")
    units = cut(marked.groupBy("unit").agg(F.count("*").alias("rows"), F.first("places").alias("places"), F.first("keys").alias("keys"), F.first("own").alias("own")))
    each = units.select("unit", F.explode(F.arrays_zip("places", "keys")).alias("x")).select("unit", F.col("x.places").alias("place"), F.col("x.keys").alias("key"))
    common = _over(each, 1)
    many = F.col("n") > split_over
    hot = each.join(common, "key").groupBy("unit").agg(F.collect_list(F.when(~many, F.col("place"))).alias("hot"), F.collect_list(F.when(many, F.col("place"))).alias("fine"))
    whole = hot.join(units.filter(F.size("own") > 0).select("unit", "own"), "unit", "full")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    asked = whole.select("unit", none("hot", "array<bigint>"), none("fine", "array<bigint>"), none("own", spans_of))
    texts = cut(long_enough.groupBy("unit").agg(F.first("raw").alias("raw")).join(asked, "unit"))
    steps = [units, common, texts]
    heavy = None
    if not common.filter(many).isEmpty():
        written = cut(texts.filter(F.size("fine") > 0).select("unit", "raw", "fine").mapInArrow(mark_pieces, "unit binary, keys array<long>"))
        parted = written.select("unit", F.explode("keys").alias("key"))
        often = _over(parted, split_over)
        heavy = cut(parted.join(often.select("key"), "key", "left_semi").groupBy("unit").agg(F.collect_set("key").alias("heavy")))
        release(written, often)
        steps.append(heavy)
    with_heavy = texts.withColumn("heavy", F.array().cast("array<bigint>")) if heavy is None else texts.join(heavy, "unit", "left").withColumn("heavy", F.coalesce("heavy", F.array().cast("array<bigint>")))
    entries = texts.agg(F.sum(F.size("hot") + F.size("fine") * len(windows) * (2 + (shortest - core) // PIECE))).first()[0] or 0
    parts = max(8, int(session.conf.get("spark.sql.shuffle.partitions")), -(-entries * (windows[0] + shortest - core) // MERGE_BYTES))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0

        def sent() -> pa.RecordBatch:
            rows = list(_runs(entries, parts, windows))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "run"])

        for batch in pieces(batches):
            for unit, raw, places, fine, heavy in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for e in _contexts(raw, set(places), set(fine), set(heavy), windows, core):
                    entries.append((*e, unit))
                    held += len(e[1]) + len(e[2]) + 200
                    if held > RUN_BYTES:
                        yield sent()
                        entries, held = [], 0
        if entries:
            yield sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = []

        def rows(spans) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*spans, strict=True), (pa.binary(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["unit", "w", "start", "end"])

        for batch in pieces(batches, 1):
            for packed in batch.column(1).to_pylist():
                run, known = pickle.loads(packed)
                if run is not None:
                    runs.append(run)
                else:
                    yield rows(known)
        held = []
        for span in _Merge(runs, windows):
            held.append(span)
            if len(held) >= 50_000:
                yield rows(held)
                held = []
        if held:
            yield rows(held)

    runs = with_heavy.select("unit", "raw", "hot", "fine", "heavy").mapInArrow(sort, "part int, run binary").repartition(parts, "part")
    own = texts.select("unit", F.explode("own").alias("x")).select("unit", "x.w", "x.start", "x.end")
    spans = runs.mapInArrow(merge, "unit binary, w int, start long, end long").unionByName(own).groupBy("unit").agg(F.array_sort(F.collect_set(F.struct("w", "start", "end"))).alias("spans"))
    return units.select("unit", "rows"), texts.select("unit", "raw").join(spans, "unit"), steps


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans united where they touch or overlap."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [tuple(x) for x in out]


def cut_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What the spans leave."""
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:a])
        last = b
    return b"".join(out) + raw[last:]


def dedup(df: DataFrame, window: int = 400, core: int = 128, report: int = 256, split_over: int = 1 << 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256, passage_bytes, has_passage.

    The last two tell of repeated strings of ``report`` bytes, at most ``window``:
    how many bytes they cover, and whether there are any.
    """
    report = min(report, window)
    windows = (window,) if report == window else (window, report)
    units, repeats, steps = removed_spans(df, windows, min(core, report), split_over, text_column)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            removed, count, digest, passages = [], [], [], []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                of, shorter = (merged([s for s in spans if s["w"] == w]) for w in (0, len(windows) - 1))
                removed.append(sum(b - a for a, b in of))
                count.append(len(of))
                digest.append(hashlib.sha256(cut_bytes(raw, of)).hexdigest())
                passages.append(sum(b - a for a, b in shorter))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(passages, pa.int64())], names=["unit", "n_removed", "n_spans", "kept_sha256", "passage_bytes"])

    judged = repeats.mapInArrow(judge, "unit binary, n_removed long, n_spans long, kept_sha256 string, passage_bytes long")
    raw = F.coalesce(df[text_column], F.lit("")).cast("binary")
    rows = df.select(df[id_column], F.length(raw).cast("long").alias("n_bytes"), F.unhex(F.sha2(raw, 256)).alias("unit"))
    # written, so that the rows of one text that very many rows repeat can be split
    known = cut(units.filter("rows > 1").select("unit", F.lit(True).alias("_copied")).join(judged, "unit", "full"))
    release(*steps)
    copied = F.coalesce("_copied", F.lit(False))
    whole = copied & (F.col("n_bytes") >= window)
    none = F.lit(0).cast("long")
    passages = F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("passage_bytes", none))
    return rows.join(known, "unit", "left").select(
        id_column,
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("unit")))).alias("kept_sha256"),
        passages.alias("passage_bytes"),
        (passages > 0).alias("has_passage"),
    )
