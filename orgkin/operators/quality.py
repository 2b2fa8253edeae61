"""Data-quality metrics and their checks, in one pass over the table."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.functions.numeric import round_exact
from orgkin.functions.text import strip
from orgkin.refdata import ENTITY_STATUSES, VALID_COUNTRIES

CHECKS = (
    "lei_not_null",
    "legal_name_not_null",
    "no_duplicate_lei",
    "country_valid_rate_above_95pct",
    "missing_address_below_30pct",
)


def invalid_country(c: str = "country", valid=VALID_COUNTRIES) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*valid)


def invalid_status(c: str = "entity_status") -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*ENTITY_STATUSES)


def valid_row(columns, valid=VALID_COUNTRIES) -> Column:
    """Key present, name not blank, country absent or accepted; absent columns pass."""
    ok = F.lit(True)
    if "lei" in columns:
        ok = ok & F.col("lei").isNotNull()
    if "legal_name" in columns:
        ok = ok & (F.coalesce(strip("legal_name"), F.lit("")) != "")
    if "country" in columns:
        ok = ok & ~invalid_country("country", valid)
    return ok


def duplicate_count(key: str = "lei") -> Column:
    """Rows after the first of their key; null keys count as one key."""
    has_null = F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0))
    return F.count(F.lit(1)) - F.count_distinct(F.col(key)) - has_null


def quality_metrics(
    df: DataFrame,
    as_of: dt.datetime | None = None,
    valid=VALID_COUNTRIES,
) -> DataFrame:
    """One row of metrics with a map of named pass/fail checks.

    A missing key or name column counts every row as missing; other absent columns
    count nothing. An empty table gives 0 rows, score 0 and no other value.
    """
    have = set(df.columns)
    total = F.count(F.lit(1))

    def missing(c: str, absent: Column) -> Column:
        return F.count_if(F.col(c).isNull()) if c in have else absent

    none = F.lit(0).cast("long")
    counted = df.agg(
        total.alias("total_records"),
        F.count_if(valid_row(have, valid)).alias("valid_records"),
        missing("lei", total).alias("missing_lei_count"),
        missing("legal_name", total).alias("missing_name_count"),
        missing("legal_address_line1", none).alias("missing_address_count"),
        (duplicate_count() if "lei" in have else none).alias("duplicate_lei_count"),
        (F.count_if(invalid_country("country", valid)) if "country" in have else none).alias(
            "invalid_country_count"
        ),
        (F.count_if(invalid_status()) if "entity_status" in have else none).alias(
            "invalid_status_count"
        ),
    )
    n = F.col("total_records")
    some = n > 0

    def share(c: str) -> Column:
        return F.col(c) / F.when(some, n)

    checks = {
        "lei_not_null": F.col("missing_lei_count") == 0,
        "legal_name_not_null": F.col("missing_name_count") == 0,
        "no_duplicate_lei": F.col("duplicate_lei_count") == 0,
        "country_valid_rate_above_95pct": 1 - share("invalid_country_count") >= 0.95,
        "missing_address_below_30pct": share("missing_address_count") <= 0.30,
    }
    pairs = [v for name in CHECKS for v in (F.lit(name), checks[name])]
    when_some = [
        c for c in (
            "missing_lei_count", "missing_name_count", "duplicate_lei_count",
            "invalid_country_count", "invalid_status_count",
        )
    ]
    return counted.select(
        F.lit(as_of).cast("timestamp_ntz").alias("run_date"),
        "total_records",
        F.when(some, F.col("valid_records")).alias("valid_records"),
        F.when(some, n - F.col("valid_records")).alias("invalid_records"),
        *[F.when(some, F.col(c)).alias(c) for c in when_some],
        round_exact(share("missing_name_count"), 4).alias("missing_name_rate"),
        round_exact(share("missing_address_count"), 4).alias("missing_address_rate"),
        F.lit(None).cast("double").alias("pipeline_runtime_seconds"),
        F.coalesce(round_exact(share("valid_records") * 100, 2), F.lit(0.0)).alias(
            "data_quality_score"
        ),
        F.when(some, F.create_map(*pairs)).alias("check_results"),
    )


def timed(metrics: DataFrame, started: float) -> DataFrame:
    """The one row of metrics, computed now, with the seconds since ``started``."""
    at = metrics.columns.index("pipeline_runtime_seconds")
    rows = [list(r) for r in metrics.collect()]
    for row in rows:
        row[at] = round(time.time() - started, 2)
    return metrics.sparkSession.createDataFrame(rows, metrics.schema)


def flat_checks(metrics: DataFrame) -> DataFrame:
    """The metrics row with one boolean column per check instead of the map."""
    flags = [F.col("check_results")[name].alias(name) for name in CHECKS]
    return metrics.select(*[c for c in metrics.columns if c != "check_results"], *flags)


def quality_issues(entities: DataFrame, valid=VALID_COUNTRIES) -> DataFrame:
    """One (lei, issue) row per failed row-level rule, the input of reports."""
    issues = F.array_compact(
        F.array(
            F.when(strip(F.coalesce("legal_name", F.lit(""))) == "", "legal name is missing"),
            F.when(F.col("legal_address_line1").isNull(), "address is missing"),
            F.when(invalid_country("country", valid), "country code is not accepted"),
            F.when(invalid_status(), "entity status is not recognised"),
        )
    )
    return entities.select("lei", F.explode(issues).alias("issue"))
