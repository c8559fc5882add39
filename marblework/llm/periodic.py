r"""Runs of periodic words, by lag scans and multi-scale minimizers.

A run is a stretch of words with smallest period q that is at least
``max(least, times * q)`` words long and that no neighbour extends.

Words of many texts are numbered together, with a number of its own between two
texts, so no stretch crosses texts.  Periods up to ``DIRECT`` are found by direct
lag scans: the words are compared with themselves q places on.  Longer periods
fall into scales, each 1.5 times the one before.  At scale w every place has the
exact name of its w words (by doubling), and a window of w places has its minimum,
the leftmost of the least names.  Inside a run of period q <= w <= 1.5 (q - 1) the
names of q neighbouring places differ and repeat q places on, so two consecutive
window minima have one name and lie q apart: each such pair is a seed.  The run is
the seed extended, word by word, to both sides.  A stretch that has been found
with a smaller period is that period's run.

Only texts that repeat any ``DIRECT`` words go on to the scales, and to each scale
only texts long enough for it.

Null text counts as empty: no words and no runs.  Words are exact: case and
punctuation count.  Texts are read whole, whatever their length; a task holds the
words of about a million characters of texts, or one longer text.  Rows are
independent, so repeated rows get equal results and an empty table gives an empty
one.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from marblework.llm.common import pieces, schema_of, ship

#: Longest period that direct lag scans look for.
DIRECT = 16
#: Characters of text whose words are worked on together.
GROUP = 1 << 20

RUN = "struct<start: long, length: long, period: long>"
FIELDS = f"n_words long, runs array<{RUN}>, collapsed string"


def _extended(ids: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` in which words q apart are equal: its start and length (with the last period)."""
    left, right, step = at, at, 64
    while right + q < len(ids):
        end = min(right + step, len(ids) - q)
        differ = np.flatnonzero(ids[right:end] != ids[right + q : end + q])
        if len(differ):
            right += int(differ[0])
            break
        right, step = end, 2 * step
    step = 64
    while left > 0:
        begin = max(left - step, 0)
        differ = np.flatnonzero(ids[begin:left] != ids[begin + q : left + q])
        if len(differ):
            left = begin + int(differ[-1]) + 1
            break
        left, step = begin, 2 * step
    return left, right + q - left


def _window_minima(values: np.ndarray, w: int) -> np.ndarray:
    """Minima of all windows of w values, from block-wise running minima of both directions."""
    n = len(values)
    padded = np.full(-(-n // w) * w, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    ahead = np.minimum.accumulate(padded.reshape(-1, w), axis=1).ravel()
    back = np.minimum.accumulate(padded.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense numbers of the pairs (a[i], b[i])."""
    return np.unique(a.astype(np.int64) << 32 | b.astype(np.int64), return_inverse=True)[1]


def _grams(names: np.ndarray, known: int, w: int) -> np.ndarray:
    """Names of w words at each place, from names of ``known`` words, known <= w <= 2 known."""
    n = len(names) - (w - known)
    return _named(names[:n], names[w - known :][:n]) if n > 0 else names[:0]


def _direct(ids: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    for q in range(1, DIRECT + 1):
        same = np.flatnonzero(ids[q:] == ids[:-q])
        need = max(least, times * q) - q
        if len(same) >= need:
            breaks = np.flatnonzero(np.diff(same) != 1)
            first, last = np.concatenate([[0], breaks + 1]), np.append(breaks, len(same) - 1)
            long = np.flatnonzero(last - first + 1 >= need)
            for a, b in zip(same[first[long]].tolist(), same[last[long]].tolist(), strict=True):
                yield a, b - a + 1 + q, q


def _scaled(ids: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Runs of periods above DIRECT; ``ids`` has the longest texts first, ``sizes`` their words with the separator."""
    names, known = ids, 1
    ends = np.cumsum(sizes)
    below = DIRECT
    while True:
        w = 3 * (below + 1) // 2
        texts = int(np.searchsorted(-sizes, -times * (below + 1), "left"))
        if not texts:
            return
        n = int(ends[texts - 1])
        names = names[:n]
        while 2 * known <= w and len(names):
            names, known = _grams(names, known, 2 * known), 2 * known
        grams = _grams(names, known, w)
        if len(grams) < w:
            return
        at = np.arange(len(grams), dtype=np.int64)
        chosen = _window_minima(grams.astype(np.int64) << 32 | at, w)
        chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
        place, name = chosen & 0xFFFFFFFF, chosen >> 32
        apart = np.diff(place)
        seeds = np.flatnonzero((name[1:] == name[:-1]) & (apart > below) & (apart <= w))
        reached: dict[int, int] = {}
        for i, q in zip(place[seeds].tolist(), apart[seeds].tolist(), strict=True):
            if i < reached.get(q, -1):
                continue
            start, length = _extended(ids[:n], i, q)
            reached[q] = start + length - q
            if length >= max(least, times * q):
                yield start, length, q
        below = w


def find_runs(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start, then period; a text is the list of its words."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) + 1 for i in order], np.int64)
    ids = np.empty(int(sizes.sum()), np.int32)
    number: dict[bytes, int] = {}
    fresh, at = count(len(texts)), 0
    for k, i in enumerate(order):
        words = texts[i]
        for word in set(words):
            if word not in number:
                number[word] = next(fresh)
        ids[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        at += len(words) + 1
        ids[at - 1] = k
    ends = np.cumsum(sizes)
    found: dict[tuple[int, int], int] = {}
    for start, length, q in _direct(ids, least, times):
        found.setdefault((start, length), q)
    again = _repeating(ids, sizes, ends)
    if len(again):
        kept = sizes[again]
        part = np.concatenate([ids[ends[k] - sizes[k] : ends[k]] for k in again])
        shift = np.repeat(ends[again] - np.cumsum(kept), kept)
        for start, length, q in _scaled(part, kept, least, times):
            found.setdefault((start + int(shift[start]), length), q)
    out: list[list] = [[] for _ in texts]
    for (start, length), q in found.items():
        k = int(np.searchsorted(ends, start, "right"))
        out[order[k]].append((start - int(ends[k] - sizes[k]), length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _repeating(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The texts in which some DIRECT words occur twice, longest first."""
    texts = int(np.searchsorted(-sizes, -4 * DIRECT, "left"))
    names, known = ids[: int(ends[texts - 1]) if texts else 0], 1
    while known < DIRECT and len(names):
        names, known = _grams(names, known, 2 * known), 2 * known
    order = np.argsort(names, kind="stable")
    text = np.searchsorted(ends, order, "right")
    return np.unique(text[1:][(names[order[1:]] == names[order[:-1]]) & (text[1:] == text[:-1])])


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        step[start + q] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """One row per row: the id, n_words, all runs, and the text with each run collapsed to its first period.

    ``times`` is 4 at least: the minimizers of shorter runs need not repeat.
    """
    if times < 4:
        raise ValueError("times must be 4 or more")
    ship(df.sparkSession)
    out = schema_of(df, [id_column], FIELDS)
    arrow = to_arrow_schema(out)
    run_type = arrow.field("runs").type

    def made(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = find_runs(texts, least, times)
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
        collapsed = [b" ".join(kept_words(w, r)).decode() for w, r in zip(texts, found, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ids, arrow.field(0).type), pa.array(list(map(len, texts)), pa.int64()), pa.array(runs, run_type), pa.array(collapsed, pa.string())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in pieces(batches):
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                texts.append((text or "").encode().split())
                held += len(text or "") + 1
                if held >= GROUP:
                    yield made(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield made(ids, texts)

    return df.select(df[id_column], df[text_column]).mapInArrow(run, out)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: the smallest start, then period.  Null without runs."""
    more = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, x: F.when(more(best, x), x).otherwise(best))


def listed(runs: Column) -> Column:
    """All runs as lines ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
