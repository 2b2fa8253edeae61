"""Registry extract: CSV scan, column mapping, sample and fallback rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin import schemas
from orgkin.operators.keyed import exact_sample
from orgkin.sources.split_csv import scan_split_csv


def scan_registry_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """All columns of a landed extract (plain or gz) as strings, named by its header.

    A quoted field may hold line breaks. Such files are read whole, one task each; say
    ``line_breaks=False`` for large plain files without them, which are then split, or use
    ``scan_split_csv``, which splits plain files with line breaks too.
    """
    return spark.read.csv(
        path, header=True, quote='"', escape='"', enforceSchema=False, multiLine=line_breaks
    )


def map_registry_columns(df: DataFrame) -> DataFrame:
    """Registry columns under their canonical names; absent ones are left out."""
    have = set(df.columns)
    return df.select(
        *[F.col(f"`{s}`").alias(t) for s, t in R.REGISTRY_COLUMNS.items() if s in have]
    )


def read_registry(
    spark: SparkSession, path: str, n: int | None = None, seed: int = R.REGISTRY_SEED,
    line_breaks: bool = True, split: bool = False,
) -> DataFrame:
    """Mapped extract in the canonical schema, all rows unless a sample of ``n`` is asked for.

    ``split`` reads large plain files by many tasks, line breaks in quotes included.
    """
    scanned = scan_split_csv(spark, path) if split else scan_registry_csv(spark, path, line_breaks)
    rows = schemas.conform(map_registry_columns(scanned), schemas.REGISTRY)
    if n is None:
        return rows
    return exact_sample(rows, n, seed, ["lei", *[c for c in rows.columns if c != "lei"]])


def fallback_registry(spark: SparkSession, rows: int = 1000) -> DataFrame:
    """Numbered stand-in companies for runs without an extract."""
    made = spark.range(1, rows + 1).select(
        F.format_string("LEI%018d", "id").alias("lei"),
        F.format_string("Sample Company %d Inc.", "id").alias("legal_name"),
        F.lit("US").alias("country"), F.lit("Delaware").alias("jurisdiction"),
        F.lit("ACTIVE").alias("entity_status"), F.lit("ISSUED").alias("registration_status"),
    )
    return schemas.conform(made, schemas.REGISTRY)
