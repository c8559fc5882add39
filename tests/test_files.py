"""Landed files: one for each row, however many there are."""

from __future__ import annotations

import hashlib
import os
from glob import glob

import duckdb
import pytest

from marblework import registry
from marblework.sources import files
from marblework.sources.shared import shared_folder


def folders(spark) -> set[str]:
    return {d for d, below, _ in os.walk(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))}


def test_manifest_needs_few_folders(spark, tmp_path):
    """A folder for each file is made, renamed, and listed by the driver one by one; suppliers of one key stay two files."""
    spark.range(3000).selectExpr("id AS s_suppkey").union(spark.range(5).selectExpr("id AS s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    before = folders(spark)
    got = registry.queries()["src_manifest"](spark, str(tmp_path))
    want = duckdb.sql(registry.oracle_sql()["src_manifest"].replace("FROM supplier", f"FROM '{tmp_path}/supplier.parquet/*.parquet'"))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert len(folders(spark) - before) <= 129


@pytest.mark.parametrize("known", [True, False])
def test_files_of_rows(spark, monkeypatch, known):
    """By pyarrow, and by Spark where Python cannot open the store."""
    if not known:
        monkeypatch.setattr(files, "located", lambda path: (_ for _ in ()).throw(ValueError(path)))
    texts = ["a", "a", "b\nc", "", None, "è", *map(str, range(200))]
    path = shared_folder(spark, "each")
    files.write_each(spark.createDataFrame([(t,) for t in texts], "value string"), path, folders=7)
    place = path.removeprefix("file://")
    assert len(glob(f"{place}/folder=*")) == 7
    assert sorted(open(f, "rb").read() for f in glob(f"{place}/*/*.txt")) == sorted((t or "").encode() + b"\n" for t in texts)
    listed = files.manifest(spark, path, "o", "s").collect()
    assert sorted(r["sha256"] for r in listed) == sorted(hashlib.sha256((t or "").encode() + b"\n").hexdigest() for t in texts)


def test_no_rows_no_files(spark):
    path = shared_folder(spark, "each")
    files.write_each(spark.createDataFrame([], "value string"), path)
    assert not glob(path.removeprefix("file://") + "/*/*") and files.manifest(spark, path, "o", "s").count() == 0
