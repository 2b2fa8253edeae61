"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgkin.session import scratch_dir

#: White space that separates words; everything else belongs to a word.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null, empty or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_RUN)
    )


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: later steps start from
    files that every executor sees, so nothing before them is computed again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def runs_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table each; the input is sorted by them.

    Holds one group and one batch at a time.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns, strict=True)):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
