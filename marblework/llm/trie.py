"""Prefix trie of conversations by range minima over sorted common prefixes.

1. A turn becomes a 16-byte digest of role and text, a conversation the binary
   path of its digests with the code points of each turn's text.
2. Paths are sorted over all tasks by (path, conversation).  Neighbours with equal
   paths fold into one entry; a task's entries are written as blocks of bounded
   size, each with the number of initial turns that it shares with the entry
   before and after it, also across blocks and tasks.
3. In a block, a sparse table holds minima of the common prefixes.  Every candidate
   prefix (entry, depth) searches its right extent, and its parent's left extent,
   by halving steps over the table, each on its own: no stack, no recursion.  An
   extent is the interval of members, so sums over subtrees are differences of
   prefix sums.
4. Only prefixes that reach over the edge of a block have parts elsewhere (at most
   the depth of a block's first and last path).  Their sums are grouped by the
   digest of the prefix and handed back to the blocks, and the block where a prefix
   begins emits it.

A path that a third of all conversations share, or a first turn, is spread over
many tasks: the sort has the conversation in its key, and sums of parts are
pre-aggregated.  SHA-256 of a node's members must read their ids in order: a task
streams them in pieces of bounded size and holds none.

Null role or text is empty.  Null turns come first; rows with equal turns are
ordered by role and then by the digest of their text, repeated rows are repeated
turns.  Rows with a null conversation belong to none and are left out.  Ids are
integers.  One conversation's digests (not its texts) are held by one task.  An
empty table has no nodes, not even a root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marblework.llm.common import cut, pieces, release, ship

#: Bytes of a turn's digest.
WIDTH = 16
#: Entries and turns at which a block ends, and characters of ids in a piece to be hashed.
BLOCK_ENTRIES, BLOCK_TURNS, PIECE_CHARS = 8192, 1 << 16, 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()

TURNS = "array<struct<digest: string, chars: long>>"
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PACKED = "kind string, part int, seq int, key binary, ids string, first binary, last binary, paths array<binary>, chars array<long>, counts array<long>, least array<long>, shas array<string>, before int, after int"
_PARTS = "part int, seq int, entry int, depth long, key binary, least long, n long, children long, leaves long, saved long, sha string"


def gather(df: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per conversation: conv_id, turns (in order, as digests with their code points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)
    turn = F.struct(F.col(turn_column).alias("at"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    whole = df.filter(F.col(conv_column).isNotNull()).groupBy(F.col(conv_column).cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many initial turns two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // WIDTH


def prefix_keys(path: bytes) -> list[bytes]:
    """A digest of the first d turns of a path, for d from 0 to all."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for i in range(0, len(path), WIDTH):
        h.update(path[i : i + WIDTH])
        out.append(h.digest())
    return out


class _Packer:
    """Folds the sorted rows of one task into entries, blocks and pieces of ids."""

    def __init__(self, part: int, block_entries: int, piece_chars: int):
        self.block_entries, self.piece_chars = block_entries, piece_chars
        self.part, self.seq, self.piece, self.block, self.turns = part, 0, 0, [], 0
        self.first = self.entry = None
        self.before = self.last = None

    def rows(self, conv: int, path: bytes, chars: list[int]) -> Iterator[dict]:
        if self.entry is None or self.entry["path"] != path:
            if self.entry is not None:
                yield from self.closed(False)
                if len(self.block) >= self.block_entries or self.turns >= BLOCK_TURNS:
                    yield self.flushed(common_turns(self.entry["path"], path))
            self.entry = {"path": path, "chars": chars, "count": 0, "least": conv, "ids": [], "size": 0, "open": self.first is None}
            self.first = path if self.first is None else self.first
        e = self.entry
        e["count"] += 1
        e["ids"].append(str(conv))
        e["size"] += len(e["ids"][-1]) + 1
        if e["size"] >= self.piece_chars:
            e["open"] = True
            yield self.ids()

    def ids(self) -> dict:
        e = self.entry
        out = {"kind": "ids", "part": self.part, "seq": self.piece, "key": prefix_keys(e["path"])[-1], "ids": ",".join(e["ids"])}
        self.piece += 1
        e["ids"], e["size"] = [], 0
        return out

    def closed(self, last: bool) -> Iterator[dict]:
        """The entry is whole: its ids are hashed here unless other rows may hold more of them."""
        e = self.entry
        e["sha"] = None if e["open"] or last else hashlib.sha256(",".join(e["ids"]).encode()).hexdigest()
        if (e["open"] or last) and e["ids"]:
            yield self.ids()
        self.block.append(e)
        self.turns += len(e["chars"])

    def flushed(self, after: int | None) -> dict:
        b = self.block
        out = {"kind": "block", "part": self.part, "seq": self.seq, "paths": [e["path"] for e in b], "chars": [c for e in b for c in e["chars"]], "counts": [e["count"] for e in b], "least": [e["least"] for e in b], "shas": [e["sha"] for e in b], "before": self.before, "after": after}
        self.seq, self.block, self.turns, self.before = self.seq + 1, [], 0, after
        return out

    def end(self) -> Iterator[dict]:
        if self.entry is not None:
            yield from self.closed(True)
            yield self.flushed(None)
            yield {"kind": "edge", "part": self.part, "first": self.first, "last": self.entry["path"]}


def _batches(rows: Iterator[dict], schema: pa.Schema, at_once: int = 16) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def pack(convs: DataFrame, block_entries: int = BLOCK_ENTRIES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Blocks, pieces of ids and the edges of tasks, written to the shared folder."""
    paths = convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    arrow = to_arrow_schema(T._parse_datatype_string(_PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), block_entries, piece_chars)

        def rows() -> Iterator[dict]:
            for batch in pieces(batches):
                for conv, path, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield from packer.rows(conv, path, chars)
            yield from packer.end()

        yield from _batches(rows(), arrow)

    return cut(paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(run, _PACKED))


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k has the minimum of 2**k values from each place."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half, low = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(low[:-half], low[half:]))
    return levels


def least_within(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The minimum of values[left..right], both ends included."""
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for level in np.unique(k):
        at = k == level
        out[at] = np.minimum(levels[level][left[at]], levels[level][right[at] - (1 << int(level)) + 1])
    return out


def reach_right(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last entry that shares ``depth`` turns with entry ``at``; values[i] is shared by entries i - 1 and i."""
    right = at.copy()
    for k in range(len(levels) - 1, -1, -1):
        fits = np.flatnonzero(right + 1 < len(levels[k]))
        ok = fits[levels[k][right[fits] + 1] >= depth[fits]]
        right[ok] += 1 << k
    return right


def reach_left(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first entry that shares ``depth`` turns with entry ``at``."""
    left = at.copy()
    for k in range(len(levels) - 1, -1, -1):
        fits = np.flatnonzero(left - (1 << k) >= 0)
        ok = fits[levels[k][left[fits] - (1 << k) + 1] >= depth[fits]]
        left[ok] -= 1 << k
    return left


def members(row: dict) -> dict[str, np.ndarray]:
    """The candidate prefixes of a block, by (first entry, depth), with their sums over this block."""
    paths, before, after = row["paths"], row["before"], row["after"]
    n = len(paths)
    size = np.fromiter((len(p) // WIDTH for p in paths), np.int64, n)
    shared = np.fromiter((-1, *(common_turns(a, b) for a, b in zip(paths, paths[1:], strict=False))), np.int64, n)
    from_before = shared.copy()
    from_before[0] = before
    to_next = np.append(shared[1:], after)
    count, least = np.array(row["counts"], np.int64), np.array(row["least"], np.int64)
    # chars of the first t turns of entry i stand at base[i] + t
    base = np.concatenate([[0], np.cumsum(size + 1)])
    so_far = np.zeros(base[-1], np.int64)
    steps = np.ones(base[-1], bool)
    steps[base[:-1]] = False
    so_far[steps] = row["chars"]
    so_far = np.cumsum(so_far)
    so_far -= np.repeat(so_far[base[:-1]], size + 1)
    whole = so_far[base[1:] - 1]

    new = size - shared
    entry = np.repeat(np.arange(n), new)
    start = np.concatenate([[0], np.cumsum(new)])
    depth = np.arange(start[-1]) - start[entry] + shared[entry] + 1
    table = minima(shared)
    right = reach_right(table, entry, depth)
    up = np.maximum(depth - 1, 0)
    left_of_parent = reach_left(table, entry, up)
    parent = start[left_of_parent] + up - shared[left_of_parent] - 1

    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    within = lambda s: s[right + 1] - s[entry]
    counted = within(sums(count))
    added = sums(whole - so_far[base[:-1] + np.maximum(from_before, 0)])
    own = whole[entry] - so_far[base[entry] + np.maximum(from_before[entry], up)]
    saved = within(sums(count * whole)) - counted * so_far[base[entry] + up] - (added[right + 1] - added[entry + 1]) - own
    is_new = depth > from_before[entry]
    children = np.bincount(parent[is_new & (depth > 0)], minlength=len(depth))
    ends = depth == size[entry]
    return {
        "entry": entry, "depth": depth, "right": right, "parent": parent, "n": counted, "saved": saved, "children": children,
        "leaves": within(sums(to_next < size)), "least": least_within(minima(least), entry, right), "ends": ends, "new": is_new,
        "open": ~is_new | (right == n - 1) & (depth <= after),
    }


def _open(row: dict, found: dict[str, np.ndarray]) -> np.ndarray:
    """Candidates with parts in other blocks, or whose ids are hashed elsewhere."""
    unhashed = np.fromiter((s is None for s in row["shas"]), bool, len(row["shas"]))
    return found["open"] | found["ends"] & unhashed[found["entry"]]


def _open_parts(row: dict) -> Iterator[dict]:
    found = members(row)
    known: dict[int, list[bytes]] = {}
    for i in np.flatnonzero(_open(row, found)):
        e, d = int(found["entry"][i]), int(found["depth"][i])
        if e not in known:
            known = {e: prefix_keys(row["paths"][e])}
        yield {"part": row["part"], "seq": row["seq"], "entry": e, "depth": d, "key": known[e][d], "sha": row["shas"][e] if found["ends"][i] else None, **{k: int(found[k][i]) for k in ("least", "n", "children", "leaves", "saved")}}


def _nodes(row: dict) -> dict[str, list]:
    """The nodes that begin in this block."""
    found = members(row)
    start = {}
    for i, (e, d) in enumerate(zip(found["entry"].tolist(), found["depth"].tolist(), strict=True)):
        start.setdefault(e, i - d)
    sha = [row["shas"][e] if end else EMPTY for e, end in zip(found["entry"], found["ends"], strict=True)]
    for x in row["merged"] or []:
        i = start[x["entry"]] + x["depth"]
        for k in ("least", "n", "children", "leaves", "saved"):
            found[k][i] = x[k]
        sha[i] = x["sha"]
    take = np.flatnonzero(found["new"])
    parent = pa.array(found["least"][found["parent"][take]], pa.int64(), mask=found["depth"][take] == 0)
    return [*(pa.array(found[k][take]) for k in ("least", "depth")), parent, *(pa.array(found[k][take]) for k in ("n", "children", "leaves", "saved")), pa.array([sha[i] for i in take], pa.string())]


def nodes(convs: DataFrame, block_entries: int = BLOCK_ENTRIES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per distinct prefix of (conv_id, turns), as NODES; ``turns`` as ``gather`` gives them.

    conv_id is the smallest member.  Each node's subtree includes itself.
    """
    ship(convs.sparkSession)
    packed = pack(convs, block_entries, piece_chars)
    edges = packed.filter("kind = 'edge'").select("part", "first", "last")
    # one row per task of the sort, whose number is a setting
    order = Window.orderBy("part")
    beside = edges.select("part", "first", "last", F.lag("last").over(order).alias("prev"), F.lead("first").over(order).alias("next"))

    def at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            part, first, last, prev, following = (c.to_pylist() for c in batch.columns)
            before = [-1 if p is None else common_turns(p, f) for p, f in zip(prev, first, strict=True)]
            after = [-1 if f is None else common_turns(x, f) for x, f in zip(last, following, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(before, pa.int32()), pa.array(after, pa.int32())], names=["part", "part_before", "part_after"])

    shared = beside.mapInArrow(at_edges, "part int, part_before int, part_after int")
    blocks = packed.filter("kind = 'block'").join(shared, "part").select("part", "seq", "paths", "chars", "counts", "least", "shas", F.coalesce("before", "part_before").alias("before"), F.coalesce("after", "part_after").alias("after"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key = h = None
            for batch in pieces(batches):
                for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if k != key:
                        if h is not None:
                            yield {"key": key, "sha": h.hexdigest()}
                        key, h = k, hashlib.sha256(ids.encode())
                    else:
                        h.update(b"," + ids.encode())
            if h is not None:
                yield {"key": key, "sha": h.hexdigest()}

        yield from _batches(rows(), pa.schema([("key", pa.binary()), ("sha", pa.string())]), 256)

    ids = packed.filter("kind = 'ids'").select("key", "ids", "part", "seq").repartition("key").sortWithinPartitions("key", "part", "seq")
    ends = ids.mapInArrow(hashed, "key binary, sha string").select(F.col("key").alias("_key"), F.col("sha").alias("_sha"))
    arrow = to_arrow_schema(T._parse_datatype_string(_PARTS))

    def open_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((x for batch in pieces(batches, 1) for row in batch.to_pylist() for x in _open_parts(row)), arrow, 256)

    parts = cut(blocks.mapInArrow(open_parts, _PARTS))
    sums = parts.groupBy("key").agg(F.min("least").alias("least"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")), F.max("sha").alias("sha"))
    merged = cut(sums.join(ends, F.col("key") == F.col("_key"), "left").select("key", "least", "n", "children", "leaves", "saved", F.coalesce("sha", "_sha", F.lit(EMPTY)).alias("sha")))
    back = parts.select("part", "seq", "entry", "depth", "key").join(merged, "key").groupBy("part", "seq").agg(F.collect_list(F.struct("entry", "depth", "least", "n", "children", "leaves", "saved", "sha")).alias("merged"))
    names = T._parse_datatype_string(NODES).names

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(_nodes(row), names=names)

    out = cut(blocks.join(back, ["part", "seq"], "left").mapInArrow(emit, NODES))
    release(packed, parts, merged)
    return out
