from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources.versions import VersionedTable


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def content(df):
    return sorted(r["n"] for r in df.collect())


def test_readers_keep_their_version_through_a_rewrite(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError, match="no published version"):
        table.current()
    table.replace(numbers(spark, 1, 2))
    reader = table.current()
    table.replace(numbers(spark, 3))
    assert content(reader) == [1, 2]
    assert content(table.current()) == [3] == content(VersionedTable(spark, str(tmp_path / "t")).current())


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=1)
    table.replace(numbers(spark, 1))
    for _ in range(3):
        table.replace(table.current().select((F.col("n") * 2).alias("n")))
    assert content(table.current()) == [8]


@pytest.mark.parametrize("dies_at", ["write", "publish"])
def test_a_rewrite_that_dies_leaves_the_old_content(spark, tmp_path, monkeypatch, dies_at):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=1)
    table.replace(numbers(spark, 1))
    reader = table.current()
    if dies_at == "write":
        with pytest.raises(Exception, match="lost"):
            table.replace(numbers(spark, 2, 3).select(F.when(F.col("n") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("long").alias("n")))
    else:
        enter = VersionedTable._enter
        with monkeypatch.context() as patch:
            patch.setattr(VersionedTable, "_enter", lambda self, n, f, s, *label: enter(self, n, f, s) if s == "begun" else 1 / 0)
            with pytest.raises(ZeroDivisionError):
                table.replace(numbers(spark, 2, 3))
    assert content(table.current()) == [1] == content(reader)
    table.replace(numbers(spark, 4))
    assert content(table.current()) == [4]


def test_old_and_dead_versions_are_emptied(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=2)
    for n in range(4):
        table.replace(numbers(spark, *range(n, n + 50)))
    folders = sorted(p for p in (tmp_path / "t").iterdir() if p.name.startswith("version="))
    assert [spark.read.parquet(str(f)).count() for f in folders] == [0, 0, 50, 50]
    # A folder is emptied once, not at every rewrite.
    stamp = folders[0].stat().st_mtime_ns
    table.replace(numbers(spark, 9))
    assert folders[0].stat().st_mtime_ns == stamp
