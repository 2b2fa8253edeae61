"""Bucketed snapshots and pages of ordered tables."""

import pytest
from pyspark.sql import functions as F

from orgkin.operators import merge, snapshots


def _upsert(stored, load):
    return merge.merge_snapshot(stored, load, "lei", ["v"])


@pytest.fixture
def first(spark, tmp_path):
    rows = spark.range(2000).select(F.format_string("L%05d", "id").alias("lei"), F.col("id").alias("v"), F.lit("x").alias("w"))
    return snapshots.create_snapshot(rows, str(tmp_path / "table"), "lei", 64)


def _load(spark, *rows):
    return spark.createDataFrame(list(rows), "lei string, v long, w string")


def test_a_load_rewrites_only_what_it_touches(spark, first):
    load = _load(spark, ("L00003", -1, "new"), ("L01999", -2, "new"), ("M1", 5, "y"), (None, 7, "z"))
    after = snapshots.upsert_snapshot(first, load, "lei", _upsert)
    changed = [b for b in after.folders if after.folders[b] != first.folders.get(b)]
    assert 1 <= len(changed) <= 3 and after.version == 1
    want = {(f"L{i:05}", i, "x") for i in range(2000)} - {("L00003", 3, "x"), ("L01999", 1999, "x")}
    want |= {("L00003", -1, "x"), ("L01999", -2, "x"), ("M1", 5, "y")}
    assert {tuple(r) for r in after.read().collect()} == want and sum(after.rows.values()) == 2001
    # the version before is still there, and the newest one is found by its manifest
    assert sum(r.v for r in first.read().collect()) == sum(range(2000))
    assert snapshots.open_snapshot(spark, first.path) == after
    assert snapshots.open_snapshot(spark, first.path, 0) == first
    again = snapshots.upsert_snapshot(after, load, "lei", _upsert)
    assert {tuple(r) for r in again.read().collect()} == want


def test_untouched_buckets_are_not_read(spark, first, plan):
    load = _load(spark, ("L00003", -1, "new"))
    seen = []

    def watched(stored, new):
        seen.append(stored)
        return _upsert(stored, new)

    snapshots.upsert_snapshot(first, load, "lei", watched)
    assert len(seen[0].inputFiles()) == 1 and seen[0].count() < 200


def test_a_run_that_fails_leaves_the_version(spark, first):
    def broken(stored, new):
        return stored.withColumn("v", F.raise_error(F.lit("lost")).cast("long"))

    with pytest.raises(Exception, match="lost"):
        snapshots.upsert_snapshot(first, _load(spark, ("L00003", -1, "new")), "lei", broken)
    assert snapshots.open_snapshot(spark, first.path) == first


def test_empty_snapshots(spark, tmp_path):
    assert snapshots.open_snapshot(spark, str(tmp_path / "none")) is None
    none = spark.createDataFrame([], "lei string, v long, w string")
    made = snapshots.create_snapshot(none, str(tmp_path / "t"), "lei", 4)
    assert made.read().collect() == [] and snapshots.open_snapshot(spark, made.path).read().collect() == []
    same = snapshots.upsert_snapshot(made, none, "lei", _upsert)
    assert same.version == 1 and same.read().collect() == []
    filled = snapshots.upsert_snapshot(same, _load(spark, ("a", 1, "x")), "lei", _upsert)
    assert [tuple(r) for r in filled.read().collect()] == [("a", 1, "x")]


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    rows = spark.range(1000).select(
        F.format_string("k%04d", "id").alias("id"), (F.col("id") % 7 / 4).alias("score"), (F.col("id") % 3).alias("kind"))
    path = str(tmp_path_factory.mktemp("ordered") / "t")
    return rows, snapshots.write_ordered(rows.repartition(5), path, [-F.col("score"), F.col("id")], 20)


@pytest.mark.parametrize("kind", [None, 1, 9])
def test_pages_follow_each_other(ordered, kind):
    rows, table = ordered
    where = None if kind is None else F.col("kind") == kind
    want = rows if where is None else rows.filter(where)
    want = [tuple(r) for r in want.orderBy(F.desc("score"), "id").collect()]
    got, cursor = [], None
    while True:
        page, cursor = table.page(130, cursor, where)
        got += [tuple(r) for r in page.collect()]
        if cursor is None:
            break
    assert got == want


def test_a_late_page_opens_as_few_files_as_the_first(ordered):
    rows, table = ordered
    first, _ = table.page(30)
    late, _ = table.page(30, [-0.25, "k0500"])
    assert len(first.inputFiles()) <= 2 and len(late.inputFiles()) <= 2
    assert [r.id for r in late.collect()][:2] == ["k0505", "k0512"]
