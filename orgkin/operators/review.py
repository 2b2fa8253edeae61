"""Reviewer decisions as an append-only log over the match table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin import schemas
from orgkin.operators.keyed import first_per_key
from orgkin.operators.search import match_page


def review_row(
    spark: SparkSession, match_id: str, decision: str, ts: dt.datetime, seq: int = 0
) -> DataFrame:
    """One log row to append; any other decision word is an error."""
    if decision not in R.REVIEWER_DECISIONS:
        raise ValueError(f"decision must be one of {R.REVIEWER_DECISIONS}")
    return spark.createDataFrame([(match_id, decision, ts, seq)], schemas.REVIEWS)


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The last decision written per match."""
    valid = reviews.filter(F.col("decision").isin(*R.REVIEWER_DECISIONS))
    last = first_per_key(valid, ["match_id"], F.desc("ts"), F.desc("seq"))
    return last.select(
        F.col("match_id").alias("id"), F.col("decision").alias("reviewer_decision"),
        F.col("ts").alias("reviewed_at"),
    )


def with_reviews(matches: DataFrame, reviews: DataFrame) -> DataFrame:
    """Matches with their last reviewer decision, null where pending."""
    return matches.join(latest_reviews(reviews), "id", "left")


def unknown_reviews(matches: DataFrame, reviews: DataFrame) -> DataFrame:
    """Last decisions that name no stored match."""
    return latest_reviews(reviews).join(matches.select("id"), "id", "left_anti")


def review_counts(reviewed: DataFrame) -> DataFrame:
    done = F.col("reviewer_decision").isNotNull()
    return reviewed.agg(F.count_if(done).alias("reviewed"), F.count_if(~done).alias("pending"))


def review_queue(
    matches: DataFrame, reviews: DataFrame, decision: str = R.REVIEW,
    limit: int = 50, offset: int = 0,
) -> DataFrame:
    """One page of matches of a decision with their reviewer state.

    The page is cut first, so the log is joined with at most ``limit`` matches.
    """
    page = match_page(matches, decision, limit, offset)
    asked = page.select(F.col("id").alias("match_id"))
    state = latest_reviews(reviews.join(asked, "match_id", "left_semi"))
    return page.join(state, "id", "left").orderBy(F.desc("final_score"), F.asc("id"))
