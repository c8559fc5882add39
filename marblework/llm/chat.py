r"""Chat formatting over a prefix tree.

A turn is written as ``### role: text</turn>`` and a newline.  Inside texts and
roles a backslash goes before each backslash, ``###`` and ``</turn>`` (in roles
also before a colon), so what was written can be read back exactly.

Conversations are sorted by their turns, so those that share initial turns meet.
A task walks its sorted share as a depth-first walk of the prefix tree: turns
that the walk already holds are not written again.  The walk is cut into packs
of bounded size; a pack starts with the ancestors of its first turn.  Each node
has its place in the pack, a position id that continues its parent's, and the
intervals of its ancestors, which are all it may attend to besides itself.
``tokens`` encodes packs: the same in tokens, each shared token emitted once.

Rows with equal turns sort by role and text.  Null role or text is empty.
A conversation without rows cannot occur; repeated conversations share all
nodes; repeated rows are repeated turns.  An empty table gives no packs.  One
conversation is held whole by a task, as one training sequence; packs exceed
``max_chars`` only for a single conversation that does.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marblework.llm import bpe
from marblework.llm.common import pieces, ship

#: The template's control strings.
BEGIN, MIDDLE, END = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int]:
    """The formatted turn, and where the text begins in it."""
    head = BEGIN + escape(role or "").replace(":", "\\:") + MIDDLE
    return head + escape(text or "") + END, len(head)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


class Pack:
    """Formatted text with its nodes, filled in depth-first order."""

    def __init__(self):
        self.text, self.size, self.nodes, self.members, self.path = [], 0, [], [], []

    def shared(self, turns: list[tuple]) -> int:
        """How many initial turns the current path has."""
        d = 0
        while d < len(self.path) and d < len(turns) and self.path[d][0] == turns[d]:
            d += 1
        return d

    def add(self, conv, turns: list[tuple]) -> None:
        del self.path[self.shared(turns) :]
        for turn in turns[len(self.path) :]:
            up = self.path[-1] if self.path else (None, -1, [])
            formatted, head = format_turn(*turn)
            start, end = self.size, self.size + len(formatted)
            parent = self.nodes[up[1]] if up[1] >= 0 else None
            trained = turn[0] == TRAINED_ROLE
            self.nodes.append({
                "start": start, "end": end, "parent": up[1],
                "position": parent["position"] + parent["end"] - parent["start"] if parent else 0,
                "ancestors": [{"start": a, "end": b} for a, b in up[2]],
                "loss_start": start + head if trained else None, "loss_end": end - len(END) if trained else None,
            })
            reach = [*up[2][:-1], (up[2][-1][0], end)] if up[2] and up[2][-1][1] == start else [*up[2], (start, end)]
            self.path.append((turn, len(self.nodes) - 1, reach))
            self.text.append(formatted)
            self.size = end
        self.members.append({"conv_id": conv, "node": self.path[-1][1]})


def pack_trees(df: DataFrame, max_chars: int = 1 << 17, max_members: int = 2000, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per pack: pack, text, nodes, members.

    Sorting is by digests of the turns and then by conversation, so a
    conversation or first turn that a third of all rows share is spread over
    tasks, each of which writes the shared turns once per pack.
    """
    ship(df.sparkSession)
    kind = df.schema[conv_column].dataType
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn_column).alias("at"), F.coalesce(F.col(role_column), F.lit("")).alias("role"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))))
    whole = df.groupBy(F.col(conv_column).alias("conv_id")).agg(turns.alias("turns"))
    path = F.array_join(F.transform("turns", lambda t: F.substring(F.sha2(F.concat(t["role"], F.lit("\n"), t["text"]).cast("binary"), 256), 1, 16)), "")
    placed = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"), path.alias("path")).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", "turns")
    span = "start: long, end: long"
    out = T.StructType(
        T._parse_datatype_string(f"pack string, text string, nodes array<struct<{span}, parent: int, position: long, ancestors: array<struct<{span}>>, loss_start: long, loss_end: long>>").fields
        + [T.StructField("members", T.ArrayType(T.StructType([T.StructField("conv_id", kind), T.StructField("node", T.IntegerType())])))]
    )
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, pack = TaskContext.get().partitionId(), 0, Pack()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"pack": f"{task}-{made}", "text": "".join(pack.text), "nodes": pack.nodes, "members": pack.members}], schema=arrow)

        for batch in pieces(batches):
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turns = [(t["role"], t["text"]) for t in turns]
                more = sum(len(t) + len(r) + 16 for r, t in turns[pack.shared(turns) :])
                if pack.members and (pack.size + more > max_chars or len(pack.members) >= max_members):
                    yield row()
                    pack, made = Pack(), made + 1
                pack.add(conv, turns)
        if pack.members:
            yield row()

    return placed.mapInArrow(run, out)


def position_ids(node: dict) -> range:
    """The position ids of a node's characters."""
    return range(node["position"], node["position"] + node["end"] - node["start"])


_NODE = "struct<start: long, end: long, parent: int, position: long, ancestors: array<struct<start: long, end: long>>, loss_start: long, loss_end: long>"


def token_nodes(text: str, nodes: list[dict], encode) -> tuple[bytes, list[int], list[dict]]:
    """(ids, position ids, nodes in tokens) of a pack; ``encode`` gives the packed ids of many texts.

    What stands before a text, the text and its end are encoded apart, so the loss
    mask ends where tokens end, and a node's tokens do not depend on its neighbours.
    """
    parts = []
    for n in nodes:
        # an untrained node has no text of its own to tell apart
        a, b = (n["loss_start"], n["loss_end"]) if n["loss_start"] is not None else (n["end"], n["end"])
        parts += [text[n["start"] : a], text[a:b], text[b : n["end"]]]
    ids = list(encode(parts))
    out, positions, at = [], [], 0
    for i, n in enumerate(nodes):
        sizes = [len(x) // 4 for x in ids[3 * i : 3 * i + 3]]
        up = out[n["parent"]] if n["parent"] >= 0 else None
        first = up["position"] + up["end"] - up["start"] if up else 0
        seen = [*up["ancestors"], {"start": up["start"], "end": up["end"]}] if up else []
        if len(seen) > 1 and seen[-2]["end"] == seen[-1]["start"]:
            seen = [*seen[:-2], {"start": seen[-2]["start"], "end": seen[-1]["end"]}]
        trained = n["loss_start"] is not None
        out.append({"start": at, "end": at + sum(sizes), "parent": n["parent"], "position": first, "ancestors": seen, "loss_start": at + sizes[0] if trained else None, "loss_end": at + sizes[0] + sizes[1] if trained else None})
        positions += range(first, first + sum(sizes))
        at += sum(sizes)
    return b"".join(ids), positions, out


def tokens(packs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per pack: pack, ids (little-endian 32-bit), positions (one per token), nodes (in tokens), members.

    A token may attend to the tokens of its node before it and to its node's
    ``ancestors`` intervals.
    """
    codec = bpe.shared_codec(packs, vocabulary)
    ship(packs.sparkSession)
    out = T.StructType([*T._parse_datatype_string(f"pack string, ids binary, positions array<long>, nodes array<{_NODE}>").fields, packs.schema["members"]])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            for row in batch.to_pylist():
                ids, positions, nodes = token_nodes(row["text"], row["nodes"], codec().encode_all)
                yield pa.RecordBatch.from_pylist([{"pack": row["pack"], "ids": ids, "positions": positions, "nodes": nodes, "members": row["members"]}], schema=arrow)

    return packs.select("pack", "text", "nodes", "members").mapInArrow(run, out)


def read_back(packs: DataFrame) -> DataFrame:
    """Conversations as the packs hold them, by their attention intervals and loss spans.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    kind = packs.schema["members"].dataType.elementType["conv_id"].dataType
    out = T.StructType([T.StructField("conv_id", kind), *T._parse_datatype_string("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])
    arrow = to_arrow_schema(out)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def read(text: str, nodes: list[dict], at: int) -> list:
        node = nodes[at]
        formatted = "".join(text[a["start"] : a["end"]] for a in node["ancestors"]) + text[node["start"] : node["end"]]
        turns, loss, i = parse(formatted), [], at
        while i >= 0:
            if nodes[i]["loss_start"] is not None:
                loss.append(unescape(text[nodes[i]["loss_start"] : nodes[i]["loss_end"]]))
            i = nodes[i]["parent"]
        trained = "".join(reversed(loss))
        return [len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(trained), sha(trained), len(formatted)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4):
            for row in batch.to_pylist():
                known: dict[int, list] = {}
                rows = []
                for m in row["members"]:
                    if m["node"] not in known:
                        known[m["node"]] = read(row["text"], row["nodes"], m["node"])
                    rows.append([m["conv_id"], *known[m["node"]]])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return packs.mapInArrow(run, out)
