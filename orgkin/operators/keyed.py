"""Keyed building blocks that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

HOT_ROWS = 1_000_000  # rows from which a key counts as hot
MAX_HOT_KEYS = 10_000  # broadcast bound: any later key has < 1/10,000 of the rows
SALTS = 64
SPREAD_BELOW_BYTES = 256 << 20


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes of all inputs the plan reads, or None where the session hides it.

    Summing the leaves avoids Catalyst's join estimate, which multiplies both sides.
    """
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        sizes = [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]
    except AttributeError:
        return None
    return sum(int(str(s)) for s in sizes)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal a small input over all cores before CPU-heavy work; large ones stay put.

    A small table often arrives in one file, so in one task. Large inputs already
    come in many partitions and are not shuffled again.
    """
    size = planned_bytes(df)
    if size is None or size > SPREAD_BELOW_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order; null keys form one group.

    ``row_number() = 1`` lets Spark prune to one row per key in every map task
    before the shuffle, so a hot key never gathers in one place.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def repeatable(df: DataFrame) -> bool:
    """Whether reading the frame twice surely gives the same rows, as far as its plan says."""
    try:
        return bool(df._jdf.queryExecution().analyzed().deterministic())
    except AttributeError:
        return False


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """``first_per_key`` by one ascending column (nulls last), for rows that are wide or costly.

    The least order of each key is found from these two columns alone, so only rows that hold
    it are widened and shuffled; the input is read twice for it. Rows that tie still leave one.
    A frame that may differ when it is read again is ranked as it is.
    """
    rows = df
    if repeatable(df):
        least = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_least"))
        # a filter, unlike a join, moves below the expressions that widen a row
        rows = df.sparkSession.sql(
            f"SELECT * FROM {{rows}} r WHERE EXISTS (SELECT 1 FROM {{least}} WHERE _key <=> r.`{key}` AND _least <=> r.`{order}`)",
            rows=df, least=least,
        )
    return first_per_key(spread(rows, key), [key], F.asc_nulls_last(order))


def top_per_key(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each key with their 1-based ``rank``."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows, largest first, at most MAX_HOT_KEYS of them."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        counts.filter(F.col("_rows") >= hot_rows)
        .orderBy(F.desc("_rows"), F.asc(key))
        .limit(MAX_HOT_KEYS)
        .select(key, F.lit(True).alias("_hot"))
    )


def keyed_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
    salted: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a large side with a side that has at most one row per key.

    This is a plain join, whose hot partitions adaptive execution splits while it runs,
    from what they hold then. With ``salted``, for sessions without it, rows of hot keys
    are dealt over SALTS sub-keys by their own content and the matching single rows are
    copied to every sub-key. Every row still meets its partner exactly once.
    """
    if not salted:
        return many.join(one, key, how)
    hot = F.broadcast(hot_keys(many, key, hot_rows))
    content = [F.col(c) for c in (salt_by or many.columns)]
    left = many.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*content), F.lit(SALTS))).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = one.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return (
        left.drop("_hot")
        .withColumn("_salt", F.col("_salt").cast("int"))
        .join(right.drop("_hot"), [key, "_salt"], how)
        .drop("_salt")
    )


def exact_sample(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by a seeded hash of ``keys``.

    Stable under repartitioning. Up to IN_ONE_GO rows this is one top-k. Beyond
    that, histograms of the hash (65,536 buckets, counted on the cluster) narrow the
    cut to one bucket at a time until what is left of it fits a top-k.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))
    hashed = df.withColumn("_h", digest)
    order = [F.asc("_h"), *[F.asc(k) for k in keys]]
    if n <= 0:
        return df.limit(0)
    taken, prefix, need = [], "", n
    while need > IN_ONE_GO and len(prefix) < 32:
        step = len(prefix) + 4
        inside = hashed.filter(F.col("_h").startswith(prefix)) if prefix else hashed
        counts = sorted(
            inside.groupBy(F.substring("_h", 1, step).alias("p")).count().collect()
        )
        cut = None
        for bucket in counts:
            if bucket["count"] > need:
                cut = bucket.p
                break
            need -= bucket["count"]
        if cut is None:
            taken.append(inside)
            need = 0
            break
        taken.append(inside.filter(F.substring("_h", 1, step) < cut))
        prefix = cut
    if need:
        rest = hashed.filter(F.col("_h").startswith(prefix)) if prefix else hashed
        taken.append(rest.orderBy(*order).limit(need))
    out = taken[0]
    for part in taken[1:]:
        out = out.unionByName(part)
    return out.drop("_h")


IN_ONE_GO = 100_000
