"""Mutations that rewrite only touched files."""

import pytest
from pyspark.sql import functions as F

from driftwell.sinks.touched import FileTable


@pytest.fixture()
def stored(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.concat(F.lit("n"), "id").alias("name"))
    return FileTable(spark, str(tmp_path / "t"), "k").create(rows, 5)


def stamps(table):
    seen = table.read().select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return {tuple(r) for r in seen.collect()}


def content(table, version=None):
    return {r.k: (r.v, r.name) for r in table.read(version).collect()}


def test_update_touches_its_files_only(stored):
    before, stamped = content(stored), stamps(stored)
    assert len(stamped) == 5
    assert len(stored.update({"k": {"$gte": 10, "$lt": 12}}, {"name": "x"})) == 1
    assert content(stored) == {k: (v, "x" if 10 <= k < 12 else n) for k, (v, n) in before.items()}
    assert len(stamps(stored) & stamped) == 4
    # an older version stays readable
    assert content(stored, 0) == before


def test_nothing_matched_writes_nothing(stored):
    assert stored.update({"k": 1000}, {"name": "x"}) == [] and stored.delete({"name": "none"}) == []
    assert stored.versions() == [0]


def test_delete_by_other_columns(stored):
    before, stamped = content(stored), stamps(stored)
    assert len(stored.delete({"name": "n42"})) == 1
    assert content(stored) == {k: r for k, r in before.items() if k != 42}
    assert len(stamps(stored) & stamped) == 4


def test_upsert(spark, stored):
    before, stamped = content(stored), stamps(stored)
    incoming = spark.createDataFrame([(3, 70, "a"), (5, 50, "b"), (200, 1, "c")], "k bigint, v bigint, name string")
    assert len(stored.upsert(incoming)) == 1
    assert content(stored) == before | {3: (70, "a"), 5: (50, "b"), 200: (1, "c")}
    assert len(stamps(stored) & stamped) == 4


def test_conditions_must_be_given(stored):
    with pytest.raises(ValueError):
        stored.delete({})
    with pytest.raises(ValueError):
        stored.update({"k": 1}, {"other": 2})
