"""Precision and recall of resolution on labelled pairs.

Pairs are read once, into a histogram of score steps with at most STEPS + 2 rows per group
and decision. The curve, its best line and the figures by decision are made from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

STEPS = 100


def score_histogram(scored: DataFrame, match: Column, by: Sequence[str] = ()) -> DataFrame:
    """``matches`` and ``others`` of each group, decision and score step.

    ``match`` says whether a pair is a true one; null says it is not. A true pair that no
    candidate holds comes in with a null score: it has step -1, which no line reaches, and
    so counts as missed on the whole curve. Scores that are no numbers do the same. An empty
    table gives no rows.
    """
    true = F.coalesce(match, F.lit(False))
    step = F.floor(F.col("final_score").try_cast("decimal(10,4)") * STEPS)
    rows = scored.select(
        *by, "decision", F.coalesce(step.cast("int"), F.lit(-1)).alias("step"), true.alias("_true")
    )
    return rows.groupBy(*by, "decision", "step").agg(
        F.count_if("_true").alias("matches"), F.count_if(~F.col("_true")).alias("others")
    )


def precision_recall(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and score step in use: what a line at ``threshold`` would give.

    A pair is found if its score is at least the threshold. ``recall`` is null in a group
    without a true pair.
    """
    steps = histogram.groupBy(*by, "step").agg(
        F.sum("matches").alias("matches"), F.sum("others").alias("others")
    )
    group = W.partitionBy(*by)
    down = group.orderBy(F.desc("step"))
    counts = steps.withColumns({
        "tp": F.sum("matches").over(down), "fp": F.sum("others").over(down),
        "_all": F.sum("matches").over(group),
    }).filter("step >= 0")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("_all") - F.col("tp")
    return counts.select(
        *by, (F.col("step") / STEPS).alias("threshold"), "tp", "fp", fn.alias("fn"),
        (tp / (tp + fp)).alias("precision"),
        F.when(F.col("_all") > 0, tp / F.col("_all")).alias("recall"),
        (2 * tp / (2 * tp + fp + fn)).alias("f1"),
    )


def best_lines(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the best f1 of each group; of equal ones the highest."""
    fields = [c for c in curve.columns if c not in by]
    best = F.max_by(F.struct(*fields), F.struct("f1", "threshold")).alias("_best")
    return curve.groupBy(*by).agg(best).filter("_best IS NOT NULL").select(*by, "_best.*")


def by_decision(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True and other pairs of each group and decision, and the share of true ones."""
    counts = histogram.groupBy(*by, "decision").agg(
        F.sum("matches").alias("matches"), F.sum("others").alias("others")
    )
    return counts.withColumn("precision", F.col("matches") / (F.col("matches") + F.col("others")))
