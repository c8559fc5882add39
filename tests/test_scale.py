"""Heads of files, running sums, answers, sketches and merged graphs."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from marblework.operators import catalog, joins, numbering, rollup, rules
from marblework.sources import heads
from marblework.sources.shared import written


class Counted:
    """A stream that knows how much of it was read."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def read(self, n: int) -> bytes:
        got = self.data[self.at : self.at + n]
        self.at += len(got)
        return got


def test_heads_stop_early():
    stream = Counted(b"a;b\n" * 5_000_000)
    assert heads.head(stream, 3) == [b"a;b"] * 3 and stream.at == heads.CHUNK
    rng = random.Random(1)
    for _ in range(500):
        data = bytes(rng.choice(b"ab\r\n\r\n;") for _ in range(rng.randint(0, 30)))
        for n in (0, 1, 2, 5, 99):
            assert heads.head(Counted(data), n, rng.randint(1, 4)) == data.splitlines()[:n], data


def test_first_lines_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfx;y\r\n1;\xe8\r\n2;3")
    (tmp_path / "b c.csv.gz").write_bytes(gzip.compress(b"k\n" * 100_000))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"no")
    got = heads.first_lines(spark, [f"file://{tmp_path}"], 2).withColumn("line", F.col("line").cast("binary")).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["place"], bytes(r["line"])) for r in got) == [("a.csv", 1, b"x;y"), ("a.csv", 2, b"1;\xe8"), ("b c.csv.gz", 1, b"k"), ("b c.csv.gz", 2, b"k")]
    slow = heads._by_spark(spark, [f"file://{tmp_path}/a.csv"], 2).withColumn("line", F.col("line").cast("binary")).collect()
    assert sorted((r["place"], bytes(r["line"])) for r in slow) == [(1, b"x;y"), (2, b"1;\xe8")]


def test_running_sums(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 5, None]), None if i % 7 else "x") for i in rng.sample(range(10_000), 3_000)] + [(None, 4, "n")]
    df = spark.createDataFrame(rows, "k long, n int, note string").repartition(7)
    got = numbering.with_start(df, ["k"], F.col("n"))
    before, want = 0, {}
    for k, n, note in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want[k] = (note, before)
        before += n or 0
    assert got.columns == ["k", "n", "note", "start"]
    assert {r["k"]: (r["note"], r["start"]) for r in got.collect()} == want
    assert numbering.with_start(df.limit(0), ["k"], F.col("n")).count() == 0


def test_running_sums_need_no_task_for_all(spark):
    totals = spark.createDataFrame([(p, p % 5 + 1) for p in range(0, 200_000, 3)], "part long, total long")
    plan = numbering.before_parts(totals, "part", "total")
    before, want = 0, {}
    for p in range(0, 200_000, 3):
        want[p] = before
        before += p % 5 + 1
    assert {r["part"]: r["before"] for r in plan.collect()} == want
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "SinglePartition" not in text


def test_answers_count_all_rows(spark):
    df = spark.range(10_000).withColumn("_at", F.lit(1)).orderBy(F.desc("id"))
    got = rollup.answer(df, 3)
    assert [tuple(r) for r in got["rows"]] == [(9999, 1), (9998, 1), (9997, 1)] and (got["total_count"], got["truncated"]) == (10_000, True)
    got = rollup.answer(df.filter("id < 3"), 3)
    assert (len(got["rows"]), got["total_count"], got["truncated"]) == (3, 3, False)
    assert rollup.answer(df.filter("id < 0"), 3) == {"rows": [], "total_count": 0, "truncated": False}
    with pytest.raises(ValueError, match="limit"):
        rollup.answer(df, 0)


def test_sketches_merge_as_if_read_together(spark):
    df = spark.range(60_000).select((F.col("id") % 4).alias("year"), (F.col("id") % 20_011).alias("k"), F.when(F.col("id") % 3 > 0, "x").alias("note"))
    stored = written(rollup.sketches(df, ["year"], ["k", "note"]), "sketches")
    parts = {r["column"]: r for r in rollup.sketched_profile(stored, []).collect()}
    once = {r["column"]: r for r in rollup.sketched_profile(rollup.sketches(df.withColumn("year", F.lit(0)), ["year"], ["k", "note"]), []).collect()}
    assert abs(parts["k"]["distinct_approx"] - once["k"]["distinct_approx"]) <= 0.02 * 20_011 and abs(parts["k"]["distinct_approx"] - 20_011) < 5 * 0.016 * 20_011
    assert parts["note"]["distinct_approx"] == 1 and parts["note"]["nulls"] == 20_000
    two = rollup.sketched_profile(rollup.merged_sketches(stored.filter("year < 2"), []), []).filter("column = 'k'").first()
    assert abs(two["distinct_approx"] - 20_011) < 5 * 0.016 * 20_011
    assert rollup.sketched_profile(stored.limit(0), ["year"]).count() == 0


def test_rules_see_all_columns(spark):
    names = [f"Col{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(str(i) for i in range(40)), (*[" "] * 5, *["x"] * 35)], ", ".join(f"{n} string" for n in names))
    assert rules.inferred_not_null(rollup.missing_cells(df), [f"col{i}" for i in range(40)]) == [f"col{i}" for i in range(5, 40)]
    assert rules.inferred_not_null(rollup.missing_cells(df.limit(0)), ["col1"]) == []
    assert rollup.missingness(df).count() == 25


def test_row_counts_read_no_column(spark, tiny):
    orders = spark.read.parquet(f"{tiny}/orders.parquet")
    got = joins.row_delta(orders, spark.read.parquet(f"{tiny}/customer.parquet"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 2
    a, b, delta = got.first()
    assert b - a == delta < 0


def test_merged_graphs_keep_bridges_once(spark):
    d = "array<struct<slug: string, column: string, semantic_type: string>>"
    nodes = spark.createDataFrame([("A", [("s", "c", "t")], [("t", 1)]), ("A", [("s", "c", "t"), ("u", "c", "t")], [("t", 2)]), ("B", [("s", "k", "v")], [("v", 1)])], f"entity string, datasets {d}, types array<struct<semantic_type: string, n: long>>")
    bridges = spark.createDataFrame([("A", "B", "p"), ("A", "B", "p"), ("A", "C", "q"), ("D", "A", "p")], "from_entity string, to_entity string, bridge string")
    got = {r["entity"]: (len(r["datasets"]), [tuple(t) for t in r["types"]], [tuple(b) for b in r["bridges"]]) for r in catalog.merge_graphs(nodes, bridges).collect()}
    assert got == {"A": (2, [("t", 3)], [("B", "p"), ("C", "q")]), "B": (1, [("v", 1)], []), "C": (0, [], []), "D": (0, [], [("A", "p")])}
    assert {r["entity"] for r in catalog.merge_graphs(nodes).collect()} == {"A", "B"}
