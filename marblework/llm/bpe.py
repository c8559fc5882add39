"""BPE encoding and decoding with a contiguous rank array per short word.

A text is cut at added tokens, then by the byte-level pattern.  A word holds its
parts and, beside them, the rank of joining each part with the next one.  The
least rank is sought by a scan of the array, the boundary behind it is deleted
and the two ranks beside it are looked up anew.  The new words of some texts are
worked on together: words of one width are the rows of one array, and each step
joins once in every row that still has something to join.  Words of more than
WIDE bytes are worked on alone, those of more than LONG keep the same parts in a
linked list with a heap of ranks, since repeated scans of a long array would
take quadratic time.

Null text is empty.  Empty text has no tokens.  Texts of any length are encoded
whole.  Rows are independent: ties and repeated rows cannot arise, an empty
table gives an empty one, and columns besides the two named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from marblework.llm.common import map_batches

#: The public byte-level pattern, and the bytes that stand for themselves in its alphabet.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

NEVER = (1 << 31) - 1
LONG = 256
#: Widths of the arrays that words are worked on in, the widest word of such an array, and how many words it takes.
WIDTHS, WIDE, TOGETHER = (4, 6, 8, 12, 16, 32), 32, 1 << 13
#: Characters of texts that are encoded together, and bytes of chunks that a Python worker remembers in each of two generations.
GROUP, REMEMBERED = 1 << 20, 16 << 20


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizers file that byte-level BPE needs; the file is bounded by its vocabulary."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, pre = said["model"], said["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or said["normalizer"]:
        raise ValueError("not a plain byte-level BPE file")
    if any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix")):
        raise ValueError("the file asks for a BPE option that is not supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in said["added_tokens"]):
        raise ValueError("added tokens with options are not supported")
    return {
        "vocab": model["vocab"],
        "merges": [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]],
        "added": {t["content"]: t["id"] for t in said["added_tokens"]},
    }


class Codec:
    """Encodes to packed little-endian 32-bit ids and decodes ids to bytes.

    Text is taken in chunks that end before a single space between other
    characters: no word of the pattern crosses such a place, so the ids of a
    chunk can be remembered.
    """

    def __init__(self, vocabulary: dict):
        spare = iter(range(256, 512))
        letter = {b: chr(b) if b in set(PRINTABLE) else chr(next(spare)) for b in range(256)}
        byte = {c: b for b, c in letter.items()}
        vocab = vocabulary["vocab"]
        self.first = [vocab[letter[b]] for b in range(256)]
        self.width = 1 + max([*vocab.values(), *vocabulary["added"].values()])
        self.rank, self.made = {}, []
        for r, (a, b) in enumerate(vocabulary["merges"]):
            self.rank[vocab[a] * self.width + vocab[b]] = r
            self.made.append(vocab[a + b])
        self.piece = [b""] * self.width
        for t, i in vocab.items():
            self.piece[i] = bytes(byte[c] for c in t)
        for t, i in vocabulary["added"].items():
            self.piece[i] = t.encode()
        self.added = {t: struct.pack("<I", i) for t, i in vocabulary["added"].items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words = regex.compile(PATTERN).findall
        self.beside = re.compile(r" \s|\s ").search
        self.chunks = re.compile(r"(?<!\s) (?!\s)").split
        self.new, self.old, self.held = dict(self.added), {}, 0
        pairs = sorted((k, r) for k, r in self.rank.items())
        self.keys, self.ranks = np.array([k for k, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64)
        self.joined, self.single = np.array(self.made, np.int64), np.array(self.first, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of joining parts; parts below 0 are none."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.ranks[at], NEVER)

    def _together(self, words: list[bytes], width: int) -> Iterator[tuple[int, bytes]]:
        """(place, packed ids) of words of at most ``width`` bytes, each a row of parts and a row of ranks."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        parts = np.where(np.arange(width) < size[:, None], self.single[raw], -1)
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        place = np.arange(len(words))

        def done(parts: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, bytes]]:
            has = parts >= 0
            ends = np.cumsum(has.sum(1)) * 4
            packed = parts[has].astype("<u4").tobytes()
            return zip(place.tolist(), [packed[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)], strict=True)

        while parts.shape[1] > 1:
            at = ranks.argmin(1)
            least = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            live = least < NEVER
            if not live.all():
                yield from done(parts[~live], place[~live])
                parts, ranks, place, at, least = parts[live], ranks[live], place[live], at[live], least[live]
                if not len(parts):
                    return
            row = np.arange(len(parts))
            parts[row, at] = self.joined[least]
            to = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, to + (to > at[:, None]), 1)
            to = to[:-1]
            ranks = np.take_along_axis(ranks, to + (to >= at[:, None]), 1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < parts.shape[1] - 1)
            ranks[left, at[left] - 1] = self._rank(parts[left, at[left] - 1], parts[left, at[left]])
            ranks[right, at[right]] = self._rank(parts[right, at[right]], parts[right, at[right] + 1])
        yield from done(parts, place)

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of different words."""
        out: dict[bytes, bytes] = {}
        by_width: dict[int, list[bytes]] = {}
        for w in words:
            n = len(w)
            if n > WIDE:
                out[w] = np.array(self.short(w) if n <= LONG else self.long(w), "<u4").tobytes()
            else:
                by_width.setdefault(next(x for x in WIDTHS if n <= x), []).append(w)
        for width, of in by_width.items():
            for i in range(0, len(of), TOGETHER):
                some = of[i : i + TOGETHER]
                out |= {some[j]: ids for j, ids in self._together(some, width)}
        return out

    def short(self, word: bytes) -> list[int]:
        """Ids by the contiguous rank array."""
        parts = [self.first[b] for b in word]
        look, made, width = self.rank.get, self.made, self.width
        ranks = [look(a * width + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            parts[i] = made[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = look(parts[i] * width + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = look(parts[i - 1] * width + parts[i], NEVER)
        return parts

    def long(self, word: bytes) -> list[int]:
        """The same ids in n log n steps."""
        parts = [self.first[b] for b in word]
        n, look, made, width = len(parts), self.rank.get, self.made, self.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := look(parts[i] * width + parts[i + 1], NEVER)) < NEVER]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (q := look(parts[x] * width + parts[y], NEVER)) < NEVER:
                    heapq.heappush(heap, (q, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def _chunks(self, text: str) -> list[str]:
        """The text's chunks and added tokens in order."""
        out: list[str] = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.added:
                out.append(piece)
            elif piece:
                first, *rest = self.chunks(piece) if self.beside(piece) else piece.split(" ")
                if first:
                    out.append(first)
                out += [" " + x for x in rest]
        return out

    def encode_group(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts; what they have of new words is worked on together.  Chunks are remembered in two generations of bounded size."""
        if self.held > REMEMBERED:
            self.old, self.new, self.held = self.new, dict(self.added), 0
        new, old = self.new, self.old
        cut = [self._chunks(t) for t in texts]
        unknown: dict[str, list[bytes]] = {}
        for chunk in set(chain.from_iterable(cut)):
            if chunk not in new:
                if (ids := old.get(chunk)) is not None:
                    new[chunk] = ids
                    self.held += len(chunk) + len(ids) + 160
                else:
                    plain = chunk[:1] == " " and chunk.isascii() and chunk[1:].isalpha()  # one word of the pattern
                    unknown[chunk] = [chunk.encode()] if plain else [w.encode() for w in self.words(chunk)]
        known = self.encode_words(list(set(chain.from_iterable(unknown.values()))))
        for chunk, words in unknown.items():
            new[chunk] = ids = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])
            self.held += len(chunk) + len(ids) + 160
        return [b"".join([new[c] for c in chunks]) for chunks in cut]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of texts, some GROUP characters of them at a time."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP:
                yield from self.encode_group(group)
                group, size = [], 0
        yield from self.encode_group(group)

    def encode(self, text: str) -> bytes:
        return self.encode_group([text])[0]

    def decode(self, ids: bytes) -> str:
        piece = self.piece
        return b"".join([piece[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode_column(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: the id, ``ids`` (binary, little-endian 32-bit) and ``n_tokens``."""
    codec = shared_codec(df, path)
    rows = lambda texts: ((ids, len(ids) // 4) for ids in codec().encode_all([t or "" for t in texts]))
    return map_batches(df, [id_column, text_column], "ids binary, n_tokens long", rows)


def shared_codec(df: DataFrame, path: str):
    """A function for tasks that gives the worker's codec; the vocabulary travels once per executor.

    The broadcast is bounded by the vocabulary file, a few MB, whatever the data.
    """
    vocabulary = read_vocabulary(path)
    held = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(json.dumps(vocabulary, sort_keys=True).encode()).hexdigest()
    return lambda: _held(key, held)


_HELD: dict[str, Codec] = {}


def _held(key: str, held) -> Codec:
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Codec(held.value)
    return _HELD[key]


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode, decode the ids, and digest both: id, n_tokens, ids_sha256, decoded_sha256."""
    codec = shared_codec(df, path)

    def rows(texts: list[str | None]) -> Iterator[tuple]:
        c = codec()
        for ids in c.encode_all([t or "" for t in texts]):
            yield len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()

    return map_batches(df, [id_column, text_column], "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
