"""Filtered pages over stored entities and matches, dashboard counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin.operators.keyed import top_per_key

ENTITY_PAGE_MAX, MATCH_PAGE_MAX, DUPLICATES_SHOWN = 100, 200, 20
_PAGE = (
    "id", "lei", "legal_name", "normalized_name", "country", "jurisdiction", "entity_status",
    "registration_status", "legal_address", "headquarters_address", "managing_lou", "source",
    "created_at",
)


def _contains(text: str) -> str:
    """A LIKE pattern for the text anywhere; a backslash in it is an ordinary character."""
    return "%" + text.replace("\\", "\\\\") + "%"


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _page_size(limit: int, at_most: int) -> int:
    if limit > at_most:
        raise ValueError(f"limit must be at most {at_most}")
    return limit


def entity_filter(
    query: str | None = None,
    country: str | None = None,
    jurisdiction: str | None = None,
    entity_status: str | None = None,
) -> Column:
    """Conjunction of the given arguments; '%' and '_' in text act as wildcards."""
    conditions = []
    if query:
        like = _contains(query)
        names = [F.col(c).ilike(like) for c in ("normalized_name", "lei", "legal_name")]
        conditions.append(names[0] | names[1] | names[2])
    if country:
        conditions.append(F.col("country") == country.upper())
    if jurisdiction:
        conditions.append(F.col("jurisdiction").ilike(_contains(jurisdiction)))
    if entity_status:
        conditions.append(F.col("entity_status") == entity_status.upper())
    return _all(conditions)


def search_entities(
    stored: DataFrame,
    query: str | None = None,
    country: str | None = None,
    jurisdiction: str | None = None,
    entity_status: str | None = None,
    limit: int = 20,
    offset: int = 0,
) -> DataFrame:
    """One page of matching entities by name; the key breaks ties."""
    n = _page_size(limit, ENTITY_PAGE_MAX)
    rows = stored.filter(entity_filter(query, country, jurisdiction, entity_status))
    return rows.select(*[c for c in _PAGE if c in stored.columns]).orderBy(
        F.asc("legal_name"), F.asc("lei")
    ).offset(offset).limit(n)


def entities_by_alias(stored: DataFrame, aliases: DataFrame, text: str) -> DataFrame:
    """Stored companies with an other name that contains the text, and the first such name.

    ``aliases`` as from ``screening.alias_rows``, one row per company and name.
    """
    like = _contains(text)
    named = aliases.filter(F.col("alias").ilike(like) | F.col("normalized_alias").ilike(like))
    return stored.join(named.groupBy("lei").agg(F.min("alias").alias("alias")), "lei")


def entity_by_lei(stored: DataFrame, lei: str) -> DataFrame:
    return stored.filter(F.col("lei") == lei)


def match_page(
    matches: DataFrame, decision: str | None = None, limit: int = 50, offset: int = 0
) -> DataFrame:
    """One page of matches, best score first; the id breaks ties."""
    n = _page_size(limit, MATCH_PAGE_MAX)
    rows = matches.filter(F.col("decision") == decision) if decision else matches
    return rows.orderBy(F.desc("final_score"), F.asc("id")).offset(offset).limit(n)


def duplicates_of(matches: DataFrame, lei: str) -> DataFrame:
    """The best 20 merge or review matches that touch one entity."""
    touching = (F.col("lei_a") == lei) | (F.col("lei_b") == lei)
    rows = matches.filter(touching & F.col("decision").isin(*R.LINKED_DECISIONS))
    return rows.orderBy(F.desc("final_score"), F.asc("id")).limit(DUPLICATES_SHOWN)


def duplicates_per_entity(matches: DataFrame, k: int = DUPLICATES_SHOWN) -> DataFrame:
    """``duplicates_of`` for every entity at once: rows with ``lei`` and ``rank``."""
    rows = matches.filter(F.col("decision").isin(*R.LINKED_DECISIONS))
    ends = F.array_distinct(F.array("lei_a", "lei_b"))
    return top_per_key(
        rows.withColumn("lei", F.explode(ends)), ["lei"], k, F.desc("final_score"), F.asc("id")
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest quality run; the id breaks ties. Empty when none is stored."""
    return runs.orderBy(F.desc("run_date"), F.desc("id")).limit(1)


def latest_quality(report: DataFrame | None, runs: DataFrame) -> DataFrame:
    """The newest stored report when there is one, else the newest run row."""
    if report is not None and not report.isEmpty():
        return report.orderBy(F.desc("run_date")).limit(1)
    return latest_run(runs)


def vector_count(index: DataFrame) -> DataFrame:
    return index.agg(F.count(F.lit(1)).alias("vector_count"))


def dashboard_stats(
    stored: DataFrame, matches: DataFrame, runs: DataFrame, index: DataFrame
) -> DataFrame:
    """One row of counts, the newest quality score and run time.

    Each table is read once; the four one-row results are folded by an aggregate
    rather than joined.
    """
    one = F.lit(1)
    parts = [
        stored.agg(
            F.count(one).alias("total_entities"),
            F.count_if(F.col("entity_status") == "ACTIVE").alias("active_entities"),
        ),
        matches.agg(
            F.count_if(F.col("decision") == R.SAME).alias("duplicate_matches"),
            F.count_if(F.col("decision") == R.REVIEW).alias("needs_review"),
        ),
        latest_run(runs).select(
            "data_quality_score", F.col("run_date").cast("string").alias("last_pipeline_run")
        ),
        vector_count(index).withColumnRenamed("vector_count", "vector_index_size"),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
