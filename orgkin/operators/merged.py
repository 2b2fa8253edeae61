"""Merged records: matched records become clusters, each with one record that says which of
its members every value comes from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin.operators.ownership import settled

FIELDS = (
    "legal_name", "normalized_name", "country", "jurisdiction", "entity_status", "registration_status",
    "legal_address_line1", "legal_address_city", "legal_address_postal",
)


def _roots(up: DataFrame) -> DataFrame:
    """``node, to`` (one row per node, ``to`` never after ``node``) -> where the pointers end.

    Every round replaces a pointer by its target's, so a chain of n takes log2(n) rounds.
    """
    now = settled(up, "cluster-pointers")
    while True:
        over = now.select(F.col("node").alias("to"), F.col("to").alias("_to"))
        after = settled(now.join(over, "to").select("node", F.col("_to").alias("to")), "cluster-pointers")
        moved = after.join(now.withColumnRenamed("to", "_was"), "node").filter(F.col("to") != F.col("_was"))
        now = after
        if moved.isEmpty():
            return now


def clusters(pairs: DataFrame, a: str = "lei_a", b: str = "lei_b") -> DataFrame:
    """``lei, cluster``: every record of a pair with another one, and the smallest key that
    pairs lead to from it. Pairs with a null or equal keys are ignored.

    Each round points every record at its smallest neighbour, follows the pointers to their
    ends, and goes on with the pairs between those ends alone, until none is left. A hub's
    pairs are summed up by a minimum before they are shuffled.
    """
    ends = pairs.filter(F.col(a) != F.col(b))
    now = settled(ends.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "cluster-pairs")
    levels: list[DataFrame] = []
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("v"))
        roots = _roots(smallest.select(F.col("u").alias("node"), F.least("u", "v").alias("to")))
        levels.append(roots)
        for c in ("u", "v"):
            now = now.join(roots.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")), c)
        now = settled(
            now.filter("_u != _v").select(F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v")).distinct(),
            "cluster-pairs",
        )
    if not levels:
        return ends.select(F.col(a).alias("lei"), F.col(a).alias("cluster")).limit(0)
    found = levels[0]
    for later in levels[1:]:
        found = found.join(later.select(F.col("node").alias("to"), F.col("to").alias("_to")), "to", "left").select(
            "node", F.coalesce("_to", "to").alias("to")
        )
    return found.select(F.col("node").alias("lei"), F.col("to").alias("cluster"))


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


def merged_records(
    entities: DataFrame,
    members: DataFrame,
    fields: Sequence[str] = FIELDS,
    newest: str = "last_update_date",
) -> DataFrame:
    """One record per cluster: ``cluster, records, real_records``, every field, and for each
    field ``<field>_from``, the key of the record it was taken from.

    ``members`` has (lei, cluster); an entity without a cluster is one of its own. Each field
    survives on its own: the value of a real record before a marked copy's, then of the one
    updated last, then of the largest key; nulls and blanks never win. All fields come from
    one aggregation, summed up before the shuffle, so a cluster may have any number of records.
    """
    named = members.select("lei", F.col("cluster").alias("_cluster"))
    rows = entities.filter(F.col("lei").isNotNull()).join(named, "lei", "left").withColumn(
        "cluster", F.coalesce("_cluster", "lei")
    )
    real = ~F.startswith(F.col("lei"), F.lit(R.SYNTHETIC_PREFIX))
    rows = rows.withColumns({"_real": real, "_rank": F.struct(real.alias("r"), F.col(newest).alias("t"), F.col("lei").alias("k"))})
    best = [
        F.max_by(F.struct(F.col(c).alias("v"), F.col("lei").alias("k")), F.when(_present(c), F.col("_rank"))).alias(f"_{c}")
        for c in fields
    ]
    found = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("_real").alias("real_records"), *best
    )
    return found.select(
        "cluster", "records", "real_records",
        *[x for c in fields for x in (F.col(f"_{c}.v").alias(c), F.col(f"_{c}.k").alias(f"{c}_from"))],
    )
