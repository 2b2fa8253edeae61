"""Split CSV reads against whole-file reads and Python's own reader."""

import csv
import random

import pytest

from orgkin.sources.registry import read_registry, scan_registry_csv
from orgkin.sources.split_csv import csv_records, scan_split_csv


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that records often lie across their edges."""
    keys = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b",
            "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(n, seed):
    rng = random.Random(seed)
    words = ["plain", 'say "hi"', "two\nlines", "a,b", '"', "", "é ü", "many\n\n\nbreaks, \"here\"\n", "x" * 90, "ends\n"]
    return [[f"K{i:04d}", rng.choice(words), rng.choice(words) + rng.choice(words)] for i in range(n)]


def _write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows([["id", "first name", "note"], *rows])


def _plain(df):
    return sorted(tuple(x or "" for x in r) for r in df.collect())


def test_rows_equal_python_and_whole_files(spark, tmp_path, small_ranges):
    both = _rows(400, 1), _rows(150, 2)
    for i, rows in enumerate(both):
        _write(tmp_path / f"{i}.csv", rows)
    got = scan_split_csv(spark, str(tmp_path))
    assert got.columns == ["id", "first name", "note"]
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    want = sorted(tuple(r) for rows in both for r in rows)
    assert _plain(got) == want
    assert _plain(scan_registry_csv(spark, str(tmp_path))) == want


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    rows = [["a", "1", "x"], ["b", "long\n" * 2000, 'and "more"'], ["c", "2", ""], ["d", "\n" * 900, "y"]]
    _write(tmp_path / "f.csv", rows)
    assert _plain(scan_split_csv(spark, str(tmp_path / "f.csv"))) == sorted(tuple(r) for r in rows)


def test_carriage_returns_blank_lines_and_edges(spark, tmp_path, small_ranges):
    _write(tmp_path / "w.csv", _rows(60, 3), end="\r\n")
    want = sorted(tuple(r) for r in _rows(60, 3))
    assert _plain(scan_split_csv(spark, str(tmp_path / "w.csv"))) == want
    (tmp_path / "b.csv").write_text('id,n\n\n1,"a"\n\n2,b')
    assert _plain(scan_split_csv(spark, str(tmp_path / "b.csv"))) == [("1", "a"), ("2", "b")]
    (tmp_path / "h.csv").write_text("id,n\n")
    assert scan_split_csv(spark, str(tmp_path / "h.csv")).count() == 0
    (tmp_path / "open.csv").write_text('id,n\n1,"a\n2,b\n')
    assert csv_records(spark, str(tmp_path / "open.csv")).count() == 2


def test_other_headers_are_refused(spark, tmp_path):
    _write(tmp_path / "1.csv", _rows(3, 4))
    (tmp_path / "2.csv").write_text("id,other,note\nz,z,z\n")
    with pytest.raises(Exception, match="another header"):
        scan_split_csv(spark, str(tmp_path)).collect()


def test_registry_columns(spark, tmp_path, small_ranges):
    path = tmp_path / "r.csv"
    path.write_text('LEI,Entity.LegalName,unknown\nA,"One\nCompany",x\nB,Two,y\n')
    got = read_registry(spark, str(path), split=True)
    assert got.columns == read_registry(spark, str(path)).columns
    assert sorted(map(str, got.collect())) == sorted(map(str, read_registry(spark, str(path)).collect()))
    assert {r.legal_name for r in got.collect()} == {"One\nCompany", "Two"}


def test_lines_are_not_shuffled_to_learn_how_their_range_begins(spark, plan, tmp_path):
    for f in range(3):
        text = "".join(f'{i},"{"x" * (i % 7)}{chr(10) if i % 5 == 0 else ""}y ""{i}""",z\n' for i in range(400))
        (tmp_path / f"{f}.csv").write_text(text)
    found = csv_records(spark, str(tmp_path))
    assert "SortMergeJoin" not in plan(found).split("Initial Plan")[0]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")  # ranges end inside records
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # and batches inside ranges
        got = sorted(r.record for r in csv_records(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    want = [f'{i},"{"x" * (i % 7)}{chr(10) if i % 5 == 0 else ""}y ""{i}""",z' for i in range(400)] * 3
    assert got == sorted(want)
