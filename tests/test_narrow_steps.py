"""First filings are found before rows are widened."""

import random

from pyspark.sql import functions as F

from orgkin.operators import keyed
from orgkin.operators.clean import dedupe_first


def _filings(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "", *"abcdef"]), rng.choice([None, *range(5)]), f"name {i}") for i in range(400)]
    return spark.createDataFrame(rows, "lei string, ingest_ord int, legal_name string")


def test_first_rows_are_those_of_the_ranking(spark):
    filings = _filings(spark)
    got = dedupe_first(filings, reread=True).collect()
    least = {}
    for r in filings.collect():
        rank = (r.ingest_ord is None, r.ingest_ord or 0)
        least[r.lei] = min(least.get(r.lei, rank), rank)
    assert {r.lei: (r.ingest_ord is None, r.ingest_ord or 0) for r in got} == least and len(got) == len(least)
    assert {tuple(r) for r in got} <= {tuple(r) for r in filings.collect()}
    nothing = spark.createDataFrame([("a", None, "x"), (None, None, "y")], filings.schema)
    assert {r.lei for r in dedupe_first(nothing, reread=True).collect()} == {"a", None}
    assert dedupe_first(filings.limit(0), reread=True).collect() == []


def test_only_first_rows_are_widened(spark):
    wide = _filings(spark).select("lei", "ingest_ord", F.md5("legal_name").alias("costly"))
    plan = keyed.first_rows(wide, "lei", "ingest_ord")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5") < plan.index("LeftSemi") and plan.count("md5") == 1


def test_frames_that_may_change_are_read_once(spark):
    drawn = _filings(spark).withColumn("ingest_ord", F.rand())
    assert not keyed.repeatable(drawn)
    plan = keyed.first_rows(drawn, "lei", "ingest_ord")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
