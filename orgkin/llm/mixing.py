"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a keyed hash as its random key. A source's documents are sorted by
that key in fixed ranges of it; the words of each range are summed, the sums of the ranges
are accumulated, and the running total inside a range starts from there. A hot source is
therefore spread over as many groups as there are ranges, and no task sees all of it.

A source's budget is its target: whole epochs first, then documents in key order until the
budget is used up, the last of them in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import documents, words, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
RANGE_DIGITS = 3  # hex digits of the key that name its range: 4,096 ranges a source


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> the same with ``target``.

    Sources take the weights by code point, null last. A target stops at MOST_EPOCHS times
    its source's size; what is over is shared by weight among the rest. That is a common
    level ``target = weight * level`` with a ceiling, and ordering sources by ceiling over
    weight gives the level from sums over those before and after. One row per source, so
    the global window is as long as the list of sources.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ceiling = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = (
        sizes.withColumn("_at", (F.row_number().over(by_name) - 1) % len(WEIGHTS))
        .withColumn("_weight", weight[F.col("_at")].cast("double"))
        .withColumn("_ceiling", F.col("source_size").cast("double") * MOST_EPOCHS)
        .withColumn("_ratio", F.col("_ceiling") / F.col("_weight"))
    )
    whole = W.partitionBy()
    before = by_ceiling.rowsBetween(W.unboundedPreceding, -1)
    after = by_ceiling.rowsBetween(W.currentRow, W.unboundedFollowing)
    all_words = F.sum("source_size").over(whole).cast("double") * SHARE
    level = (all_words - F.coalesce(F.sum("_ceiling").over(before), F.lit(0.0))) / F.sum(
        "_weight"
    ).over(after)
    return (
        ranked.withColumn("_own", level)
        .withColumn("_level", F.max(F.when(F.col("_own") <= F.col("_ratio"), F.col("_own"))).over(whole))
        .withColumn(
            "target",
            F.when(F.col("_ratio") >= F.col("_level"), F.col("_weight") * F.col("_level"))
            .otherwise(F.col("_ceiling")),
        )
        .select("source", "source_size", "target")
    )


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken``.

    ``taken`` counts words with repeats. A null text has size 0; a null source is a source
    of its own; rows with equal ids each count, and equal rows may stand for each other.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = written(
        docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
        .withColumn("_key", key),
        "mix-sizes",
    ).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("_words").alias("source_size")))
    up_to = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_words").over(up_to), F.lit(0))).alias("r")
    t = targets.alias("t")
    plan = starts.join(t, F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        F.col("r.source").alias("_source"), F.col("_range").alias("_of"), "_start",
        "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).alias("_epochs"),
    )
    inside = (
        W.partitionBy("source", "_range").orderBy("_key", "doc_id", "size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    placed = sized.withColumn("_ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rest = F.floor("target") - F.col("_epochs") * F.col("source_size")
    left = rest - F.col("_start") - F.col("_ahead")
    taken = F.col("_epochs") * F.col("size") + F.greatest(
        F.lit(0), F.least(F.col("size"), left)
    )
    return placed.join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_of"))
    ).select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The documents of the mix, with their own columns: one row for every time a document
    is taken, whole. A document that the budget cuts is taken whole.

    Rows that share an id share the decision of one of them. Empty documents weigh nothing
    and stay once.
    """
    times = F.when(F.col("size") == 0, 1).otherwise(F.ceil(F.col("taken") / F.col("size")))
    decided = (
        mix(docs, seed).groupBy(F.col("doc_id").alias("_mixed_id"))
        .agg(F.max(times).cast("int").alias("_mixed_times"))
    )
    return (
        docs.join(decided, docs["doc_id"].eqNullSafe(F.col("_mixed_id")))
        .filter("_mixed_times > 0")
        .withColumn("_mixed_at", F.explode(F.sequence(F.lit(1), F.col("_mixed_times"))))
        .select(*[docs[c] for c in docs.columns])
    )


def query(spark, sf_dir):
    return mix(documents(spark, sf_dir)).drop("source")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, source_size::DOUBLE * {MOST_EPOCHS} AS ceiling, ceiling / weight AS ratio
  FROM (SELECT *, [{', '.join(map(str, WEIGHTS))}][
          ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT
        ]::DOUBLE AS weight FROM sizes)),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * {SHARE}
             - coalesce(sum(ceiling) OVER (ORDER BY ratio, encode(source) NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY ratio, encode(source) NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM ranked),
leveled AS (SELECT *, max(CASE WHEN own <= ratio THEN own END) OVER () AS level FROM levels),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio >= level THEN weight * level ELSE ceiling END AS target,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM leveled),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized)
SELECT p.doc_id, p.size, t.source_size, t.target,
       (t.epochs * p.size + greatest(0, least(p.size,
          floor(t.target)::BIGINT - t.epochs * t.source_size - p.ahead)))::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""
