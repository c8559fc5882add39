"""MinHash near-dedup with bottom-k sketches of one hash function.

1. A text's set is its distinct word shingles, each one 64-bit hash.  Texts with
   equal sets form a class; one member stands for it.
2. A class keeps the k least hashes of its set.  Two sets that link must share at
   least ``c`` kept values, so in any global order of values they share one
   among the first |sketch| - c + 1 of each.  A small sketch sieves first: a
   class with fewer than its ``c`` values that any other class keeps cannot
   link and drops out before its text is moved.  For the others, inverted lists
   hold the first values of a larger sketch, rarest first.  A text whose rare
   values fill that prefix meets nobody through common passages.
3. Short lists give all their pairs.  In a long list the members are compared
   with its leaders, the first members of its components so far; the lists that
   still hold several components go on with more leaders.  No list is capped and
   no link between components is lost: a list ends when it has one component or
   when all its members have led.
4. The union sketch of a pair estimates its similarity; pairs of small sets are
   decided by it exactly, the others are confirmed on their full sets.
5. Components of the links come from star rounds over the link table.

The only chance in it is step 2's ``c`` and step 4's margin for sets larger than
the sketch: both lie six standard deviations below what the threshold implies.
A pair's sizes sharpen ``c``, and with it the positions that its first shared
value may have.

Null, empty and wordless texts have an empty set and link with nothing.  Texts
are read whole.  Rows with one id count as one document for linking; each row
keeps its own set size.  A row with a null id has a null component and is kept.
An empty table gives an empty result.  Ids are integers.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marblework.llm.common import cut, pieces, release, ship, unused
from marblework.llm.graph import PARTS, components, for_parts, part_of

SIGMAS = 6.0
#: Lists of at most so many members give all their pairs.
SHORT_LIST = 16
#: Leaders of a long list in the first round, and their growth from round to round.
LEADERS, GROWTH = 2, 16
#: Removed ids that are broadcast at most: some tens of MB.
BROADCAST_IDS = 1 << 20
_M = 0x9E3779B97F4A7C15


class _Hashes(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    roll = np.full(n, width, np.uint64)
    for i in range(width):
        roll = _mix(roll * np.uint64(_M) + h[i : i + n])
    return np.unique(roll)


def _surely(expected, share, drawn: int, of):
    """The least that hypergeometric draws with this expectation give, SIGMAS below it."""
    return F.floor(expected - SIGMAS * F.sqrt(drawn * share * (1 - share) * (of - drawn) / (of - 1)))


def pair_overlap(n, m, k: int, threshold: float):
    """How many kept values two sets of these sizes (Columns) share at least if they link.

    Up to k values the sets are kept whole and the bound is exact; beyond, the
    larger set's sketch is a random draw from it.
    """
    large, shared = F.greatest(n, m), (n + m) * (threshold / (1 + threshold))
    share = F.least(F.lit(1.0), shared / large)
    return F.greatest(F.lit(1), F.when(large <= k, F.ceil(shared - 1e-9)).otherwise(_surely(k * share, share, k, large)))


def least_overlap(n, k: int, threshold: float):
    """The least of pair_overlap over all sizes that a set of size n can link to."""
    exact, partner = F.ceil(n * threshold - 1e-9), F.ceil(n / threshold)
    drawn = _surely(F.lit(threshold * k), F.lit(threshold), k, partner)
    return F.greatest(F.lit(1), F.when(partner <= k, exact).otherwise(F.least(drawn, exact)))


def sketches(df: DataFrame, k: int, width: int, id_column: str, text_column: str) -> DataFrame:
    """id, n (set size), class (digest of the set), sketch (the k least hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            size, digest, kept = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width)
                size.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                kept.append(s[:k].view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(size, pa.int32()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["id", "n", "class", "sketch"])

    return df.select(df[id_column].cast("long").alias("id"), df[text_column]).mapInArrow(run, "id long, n int, class binary, sketch array<long>")


def prefix_lists(reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """(v, df, id, n, pos), written: the kept values, rarest first, that may be the first shared one of a link; pos counts from 1."""
    each = reps.select("id", "n", F.explode("sketch").alias("v"))
    # written, so that the join's sides are plain exchanges and Spark can split a value that very many keep
    common = cut(each.groupBy("v").agg(F.count("*").cast("int").alias("df")).filter("df > 1"))
    shared = each.join(common, "v").groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))
    # values that nobody else keeps come first in the order and need no list
    own = F.least(F.col("n"), F.lit(k)) - F.size("vs")
    room = (F.least(F.col("n"), F.lit(k)) - least_overlap(F.col("n"), k, threshold) + 1 - own).cast("int")
    out = cut(shared.filter(room > 0).select("id", "n", own.alias("own"), F.posexplode(F.slice("vs", F.lit(1), room)).alias("i", "x")).select("x.v", "x.df", "id", "n", (F.col("own") + F.col("i") + 1).alias("pos")))
    release(common)
    return out


def may_link(n, pos, m, at, k: int, threshold: float):
    """Whether sets of sizes n and m can link if the first value that they share is at these positions."""
    c = pair_overlap(n, m, k, threshold)
    return (n >= F.lit(threshold) * m) & (m >= F.lit(threshold) * n) & (F.least(n, F.lit(k)) - pos + 1 >= c) & (F.least(m, F.lit(k)) - at + 1 >= c)


def with_earlier(lists: DataFrame) -> DataFrame:
    """(v, id, n, pos, earlier): ``earlier`` are the values of an id's lists before this one.

    Two ids that share an earlier value meet in that list, so a pair is compared
    in one list only.
    """
    per = lists.groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("xs"))
    each = per.select("id", "n", "xs", F.posexplode("xs").alias("i", "x"))
    return each.select("x.v", "id", "n", "x.pos", F.transform(F.slice("xs", F.lit(1), F.col("i")), lambda y: y["v"]).alias("earlier"))


def short_pairs(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """All pairs of the short lists."""
    held = lists.filter(F.col("df") <= SHORT_LIST).groupBy("v").agg(F.collect_list(F.struct("id", "n", "pos")).alias("xs")).filter(F.size("xs") > 1)
    pairs = F.flatten(F.transform("xs", lambda x: F.transform(F.filter("xs", lambda y: (y["id"] > x["id"]) & may_link(x["n"], x["pos"], y["n"], y["pos"], k, threshold)), lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))))
    return held.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def confirmed(pairs: DataFrame, reps: DataFrame, full: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs that link: estimated on union sketches, then exact.  ``full`` has (id, set) of all that may be asked for."""
    side = lambda at: reps.select(F.col("id").alias(at), F.col("n").alias(f"n_{at}"), F.col("sketch").alias(f"s_{at}"))
    margin = SIGMAS * math.sqrt(threshold * (1 - threshold) / k)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sure, maybe = [], []
            for a, b, n, m, s, t in zip(*(c.to_pylist() if i < 4 else c for i, c in enumerate(batch.columns)), strict=True):
                s, t = (x.values.to_numpy().view(np.uint64) for x in (s, t))
                union = np.union1d(s, t)
                both = np.intersect1d(s, t, assume_unique=True)
                if n <= k and m <= k:
                    sure.append(len(both) >= threshold * len(union))
                    maybe.append(False)
                else:
                    top = union[:k]
                    sure.append(False)
                    maybe.append(np.searchsorted(both, top[-1], "right") >= (threshold - margin) * len(top))
            sure, maybe = np.array(sure, bool), np.array(maybe, bool)
            take = pa.array(sure | maybe)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(take), batch.column(1).filter(take), pa.array(sure[sure | maybe])], names=["a", "b", "sure"])

    asked = cut(pairs)
    if asked.isEmpty():
        return asked
    judged = cut(asked.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(judge, "a long, b long, sure boolean"))
    release(asked)
    ask = judged.filter("not sure").select("a", "b")
    if ask.isEmpty():
        return judged

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both >= threshold * (len(s) + len(t) - both))
            take = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(take), batch.column(1).filter(take)], names=["a", "b"])

    side = lambda at: full.select(F.col("id").alias(at), F.col("set").alias(f"s_{at}"))
    sure = ask.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(exact, "a long, b long")
    out = cut(judged.filter("sure").select("a", "b").unionByName(sure))
    release(judged)
    return out


def joined_components(found: DataFrame, fresh: DataFrame) -> DataFrame:
    """``found`` (node, component) after further links (a, b): only the components that they touch are worked on."""
    end = lambda at: found.select(F.col("node").alias(at), F.col("component").alias(f"c_{at}"))
    over = fresh.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    touched = components(over)
    moved = touched.select(F.col("node").alias("_from"), F.col("component").alias("_to"))
    kept = found.join(moved, F.col("component") == F.col("_from"), "left").select("node", F.coalesce("_to", "component").alias("component"))
    new = moved.join(found.select("node"), F.col("_from") == F.col("node"), "left_anti").select(F.col("_from").alias("node"), F.col("_to").alias("component"))
    out = cut(kept.unionByName(new))
    release(found, touched)
    return out


def link(df: DataFrame, k: int = 160, sieve: int = 64, width: int = 5, threshold: float = 0.75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, n_shingles, component_id, kept."""
    ship(df.sparkSession)
    rows = cut(sketches(df, sieve, width, id_column, text_column))
    classes = cut(rows.filter("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    each = classes.select("id", "n", F.explode("sketch").alias("v"))
    common = cut(each.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1").select("v"))
    met = each.join(common, "v", "left_semi").groupBy("id", "n").agg(F.count("*").alias("met"))
    meets = met.filter(F.col("met") >= least_overlap(F.col("n"), sieve, threshold)).select(F.col("id").alias("_id")).distinct()
    texts = cut(df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).join(meets, F.col("id") == F.col("_id"), "left_semi"))
    reps = cut(sketches(texts, k, width, "id", "text").groupBy("id", "class").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")).drop("class"))
    lists = prefix_lists(reps, k, threshold)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, width).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["id", "set"])

    full = cut(texts.mapInArrow(sets, "id long, set binary"))
    links = confirmed(short_pairs(lists, k, threshold), reps, full, k, threshold)
    found = components(links)
    release(links)
    long_lists = cut(with_earlier(lists.filter(F.col("df") > SHORT_LIST)))
    leaders = LEADERS
    while True:
        placed = long_lists.join(found, F.col("id") == F.col("node"), "left").select("v", "id", "n", "pos", "earlier", F.coalesce("component", "id").alias("comp"))
        several = placed.groupBy("v").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("v")
        placed = cut(placed.withColumn("part", part_of(F.col("id"))).join(for_parts(several), ["v", "part"], "left_semi").drop("part"))
        release(long_lists)
        if placed.isEmpty():
            release(placed)
            break
        first = placed.groupBy("v", "comp").agg(F.min(F.struct("id", "n", "pos", "earlier")).alias("lead"))
        # any components may lead: many leaders are chosen in parts, so that no task ranks a whole long list
        parts = max(1, min(PARTS, leaders // 4))
        rank = F.row_number().over(Window.partitionBy("v", F.pmod(F.xxhash64("lead.id"), F.lit(parts))).orderBy("lead.id"))
        led = cut(first.withColumn("rank", rank).filter(F.col("rank") <= -(-leaders // parts)).select(F.col("v"), F.col("lead.id").alias("l"), F.col("lead.n").alias("l_n"), F.col("lead.pos").alias("l_pos"), F.col("lead.earlier").alias("l_earlier"), F.col("comp").alias("l_comp")))
        pairs = placed.join(led, "v").filter((F.col("comp") != F.col("l_comp")) & ~F.arrays_overlap("earlier", "l_earlier") & may_link(F.col("n"), F.col("pos"), F.col("l_n"), F.col("l_pos"), k, threshold))
        fresh = confirmed(pairs.select(F.least("id", "l").alias("a"), F.greatest("id", "l").alias("b")).distinct(), reps, full, k, threshold)
        if not fresh.isEmpty():
            found = joined_components(found, fresh)
        release(fresh)
        long_lists = cut(placed.select("v", "id", "n", "pos", "earlier").join(led.select("v", F.col("l").alias("id")), ["v", "id"], "left_anti"))
        release(placed, led)
        leaders *= GROWTH
    rep = classes.select("class", F.col("id").alias("rep")).join(found, F.col("rep") == F.col("node"), "left").select("class", F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("id", "n", "class").join(rep, "class", "left")
    component = F.coalesce("component_id", "id")
    out = cut(out.select(F.col("id").alias(id_column), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))
    release(rows, classes, common, texts, reps, lists, full, found)
    return out


def keep_one(df: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """All columns of the rows whose id stands for its component; empty texts and null ids stay.

    Up to BROADCAST_IDS removed ids, counted first, are broadcast, so that no text
    moves; more of them are joined by id.
    """
    name = unused(df, "_gone")
    found = link(df, id_column=id_column, **options)
    gone = cut(found.filter("NOT kept").select(F.col(id_column).alias(name)).distinct())
    release(found)
    few = gone.count() <= BROADCAST_IDS
    return df.join(F.broadcast(gone) if few else gone, df[id_column] == gone[name], "left_anti")
