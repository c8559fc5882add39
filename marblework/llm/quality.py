"""Quality rules on repetition coverage.

Words get numbers within their text; n-grams of several lengths get rolling
hashes in numpy.  A repeated n-gram contains repeated shorter ones, so each
length is only looked at where the one before it repeats.  The verdict measures
characters inside repeated n-grams and lines as shares of all word characters.

Null text counts as empty: no words, base_failed.  Texts are read whole,
whatever their length.  Rows are independent, so repeated rows get equal
results; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from marblework.llm.common import SPACED_WORD, map_rows

SYMBOLS = "#*$%&|<>"
#: The most that characters in repeated n-grams and lines may take of all word characters.
MOST_IN_NGRAMS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
MOST_IN_TOP = {2: 0.20, 3: 0.18, 4: 0.16}
MOST_IN_LINES = 0.30
#: A top n-gram must occur so often to count.
TOP_TIMES = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it is a later occurrence."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:]] = same
    later[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def measure(text: str | None) -> dict:
    """All figures of one text."""
    text = text or ""
    words = SPACED_WORD.findall(text)
    n = len(words)
    number: dict = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for w in words), np.uint64, n)
    size = np.fromiter(map(len, words), np.int64, n)
    chars = int(size.sum())
    total = max(chars, 1)
    out = {"n_words": n, "word_chars": chars, "n_symbols": sum(map(text.count, SYMBOLS))}

    seen, dup_lines, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if SPACED_WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, SPACED_WORD.findall(line)))
            seen.add(line)
    out |= {"n_dup_lines": dup_lines, "line_share": dup_chars / total}

    ends = np.concatenate([[0], np.cumsum(size)])
    roll, at = _mixed(ids + _MIX), np.arange(n)
    word_hash = roll
    top, shares, repeat_words = {}, {}, 0
    for k in range(2, 11):
        ok = at + k <= n
        at, roll = at[ok], roll[ok]
        roll = _mixed(roll * _MIX + word_hash[at + k - 1])
        twice, later = _repeats(roll)
        if k in MOST_IN_TOP and len(at):
            got, first, times = np.unique(roll, return_index=True, return_counts=True)
            weight = times * (ends[at[first] + k] - ends[at[first]])
            weight[times < TOP_TIMES] = 0
            top[k] = int(weight.max()) / total
        if k == 8:
            repeat_words = int(_covered(at[twice], k, n).sum())
        if k in MOST_IN_NGRAMS:
            shares[k] = int(size[_covered(at[later], k, n)].sum()) / total
        at, roll = at[twice], roll[twice]
        if not len(at):
            break
    out |= {"n_repeat_words": repeat_words, "top_share": max(top.values(), default=0.0), "ngram_share": max(shares.values(), default=0.0)}
    out["base_failed"] = n < 20 or 100 * repeat_words > 30 * n
    good = out["line_share"] <= MOST_IN_LINES and all(top.get(k, 0) <= v for k, v in MOST_IN_TOP.items()) and all(shares.get(k, 0) <= v for k, v in MOST_IN_NGRAMS.items())
    out["kept"] = good and not out["base_failed"]
    return out


def _covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """The words inside the k-word windows that start at ``at``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + k, -1)
    return np.cumsum(step[:-1]) > 0


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_share double, top_share double, ngram_share double, base_failed boolean, kept boolean"


def assess(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: the id and FIELDS."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def row(text: str | None) -> list:
        got = measure(text)
        return [got[k] for k in names]

    return map_rows(df, [id_column, text_column], FIELDS, row)
