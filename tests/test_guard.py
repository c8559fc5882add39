"""Ad-hoc SQL: what the guard refuses and what it lets through."""

from __future__ import annotations

import pytest

from marblework.cases.adhoc import REFUSED
from marblework.plans import adhoc

PASSED = {
    "SELECT 'drop table x; -- reflect(' AS a, `n` FROM ordini WHERE s <> 'it''s\n' ORDER BY 2 LIMIT 1;": [("drop table x; -- reflect(", 1)],
    "WITH a AS (SELECT n FROM ordini), b AS (SELECT max(n) AS m FROM a) SELECT n, (SELECT m FROM b) AS m FROM a WHERE n IN (SELECT n FROM clienti)": [(2, 3)],
    "SELECT sum(n) OVER (PARTITION BY 1 ORDER BY n) AS t FROM ordini": [(1,), (3,), (6,)],
    "SELECT count(*) AS c, rank() OVER w AS r FROM ordini GROUP BY n HAVING n > 1 WINDOW w AS (ORDER BY n)": [(1, 1), (1, 2)],
    "SELECT x + 1 FROM ordini LATERAL VIEW explode(transform(array(n), k -> k * 10)) t AS x": [(11,), (21,), (31,)],
    "SELECT CASE WHEN n BETWEEN 1 AND 2 THEN upper(s) ELSE replace(s, 'c', 'z') END FROM ordini": [("A",), ("B",), ("z",)],
    "SELECT o.n FROM ordini o LEFT ANTI JOIN clienti c USING (n) UNION SELECT CAST(n AS BIGINT) FROM clienti": [(1,), (2,), (3,)],
    "SELECT extract(YEAR FROM DATE '2020-01-02') AS y, trim(BOTH ' ' FROM s) AS t, * FROM ordini WHERE n = 1": [(2020, "a", 1, "a")],
}


@pytest.fixture(scope="module")
def frames(spark):
    return {"ordini": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n long, s string"), "clienti": spark.createDataFrame([(2,)], "n long")}


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(spark, frames, sql):
    with pytest.raises(ValueError, match="not allowed|not declared|no valid SQL"):
        adhoc.guarded(spark, sql, frames)


@pytest.mark.parametrize("sql", PASSED)
def test_passed(spark, frames, sql):
    assert sorted(tuple(r) for r in adhoc.guarded(spark, sql, frames).collect()) == PASSED[sql]


def test_functions_of_a_session_are_refused(spark, frames):
    spark.udf.register("own_function", lambda x: x, "long")
    with pytest.raises(ValueError, match="functions not allowed"):
        adhoc.guarded(spark, "SELECT own_function(n) FROM ordini", frames)


def test_a_common_table_that_hides_one_is_refused(spark, frames):
    spark.range(3).createOrReplaceTempView("hidden")
    try:
        with pytest.raises(ValueError, match="hides"):
            adhoc.guarded(spark, "WITH hidden AS (SELECT 1) SELECT * FROM hidden", frames)
    finally:
        spark.catalog.dropTempView("hidden")


def test_answers_know_their_total(spark, frames):
    got = adhoc.layer_answer(spark, frames, "SELECT n FROM ordini ORDER BY n DESC", 2)
    assert got["columns"] == ["n"] and [r["n"] for r in got["rows"]] == [3, 2] and (got["total_count"], got["truncated"]) == (3, True)
