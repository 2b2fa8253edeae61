"""Stage tables, stored tables and append-only logs on shared storage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgkin import schemas
from orgkin.operators.clean import stage_boundary

STORED = {
    "entities": schemas.STORED_ENTITIES,
    "entity_resolution_matches": T.StructType(
        schemas.MATCHES.fields
        + [T.StructField("reviewer_decision", T.StringType()),
           T.StructField("reviewed_at", T.TimestampNTZType())]
    ),
    "data_quality_runs": schemas.QUALITY_RUNS,
    "verification_reports": schemas.REPORTS,
}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row count observed by whatever action runs next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_stage(df: DataFrame, path: str, *partition_by: str, blanks: bool = False) -> DataFrame:
    """Write a stage with blanks as null and read it back: the hand-off, and the lineage cut.

    ``blanks`` keeps blank text, for stored tables whose defaults are blank.
    """
    writer = (df if blanks else stage_boundary(df)).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored extract when it exists, else build, store and read it."""
    found = read_or_none(spark, path)
    if found is not None:
        return found
    build().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Stored vectors by key; an empty frame of the same shape when there are none."""
    found = read_or_none(spark, path)
    return spark.createDataFrame([], schemas.VECTORS) if found is None else found


def write_vectors(vectors: DataFrame, path: str) -> None:
    schemas.conform(vectors, schemas.VECTORS).write.mode("overwrite").parquet(path)


def relationships(spark: SparkSession, rows: list[dict] | DataFrame) -> DataFrame:
    """Ownership rows from a frame or a short list of dicts, in the canonical schema."""
    if isinstance(rows, DataFrame):
        return schemas.conform(rows, schemas.RELATIONSHIPS)
    names = schemas.RELATIONSHIPS.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                 schemas.RELATIONSHIPS)


def ensure_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the stored tables that do not exist yet."""
    made = []
    for name, schema in STORED.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet")
        made.append(prefix + name)
    return made


def read_table(spark: SparkSession, name: str, jdbc: dict | None = None) -> DataFrame:
    """A stored table from the catalog, or from a database with JDBC options."""
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc, dbtable=name).load()
    return spark.table(name)


def append_table(df: DataFrame, name: str) -> None:
    schemas.conform(df, df.sparkSession.table(name).schema).write.insertInto(name)


def quality_run_row(metrics: DataFrame) -> DataFrame:
    """The typed run row of a metrics frame; its id follows from its content."""
    run = metrics.withColumn(
        "id", F.sha2(F.concat_ws(":", F.col("run_date").cast("string"),
                                 *[F.col(c).cast("string") for c in
                                   ("total_records", "valid_records", "data_quality_score")]), 256)
    )
    return schemas.conform(run, schemas.QUALITY_RUNS)


def write_quality_report(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append the full report as JSON under its run id; the newest one is a query."""
    report = metrics.withColumn("run_id", F.lit(run_id))
    report.write.mode("append").partitionBy("run_id").json(path)


def read_quality_reports(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("prefersDecimal", False).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def as_of_now() -> dt.datetime:
    """Current UTC time without zone, taken once per run and passed along."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
