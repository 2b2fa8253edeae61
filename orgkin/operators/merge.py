"""Snapshot upserts and insert-if-absent.

Each call returns the complete next snapshot; callers write it to a new path and
never over the one being read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin import schemas
from orgkin.functions.profile import pack_hq_address, pack_legal_address
from orgkin.operators.keyed import first_per_key
from orgkin.refdata import DEFAULT_SOURCE, SYNTHETIC_PREFIX

ENTITY_UPDATES = (
    "legal_name", "normalized_name", "entity_status", "registration_status",
    "legal_address", "headquarters_address", "updated_at",
)


def real_key(c: str = "lei") -> Column:
    """Key present and not a synthetic duplicate's."""
    return (
        F.col(c).isNotNull() & (F.col(c) != "") & ~F.startswith(F.col(c), F.lit(SYNTHETIC_PREFIX))
    )


def merge_snapshot(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    small_source: bool = False,
) -> DataFrame:
    """Target with ``source`` merged in; both sides have unique keys.

    A matched row takes only the ``update`` columns; an unmatched source row is
    inserted whole. One full outer join merges both sides. A caller who knows that the
    source has a fixed small size may say so: it is then broadcast, and the target is
    scanned but never shuffled.
    """
    cols = target.columns
    s = source.select(
        F.col(key), F.lit(True).alias("_new"),
        *[F.col(c).alias(f"_s_{c}") for c in cols if c != key],
    )

    def pick(c: str) -> Column:
        if c == key:
            return F.col(key)
        if c in update:
            return F.when(F.col("_new"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        if small_source:
            return F.col(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c)

    if small_source:
        side = F.broadcast(s)
        kept = target.join(side, key, "left").select(*[pick(c) for c in cols])
        known = target.select(key).join(F.broadcast(source.select(key)), key, "left_semi")
        fresh = source.join(known, key, "left_anti").select(*cols)
        return kept.unionByName(fresh)
    t = target.withColumn("_old", F.lit(True))
    return t.join(s, key, "full_outer").select(*[pick(c) for c in cols])


def fold_source(source: DataFrame, key: str, update: Sequence[str], order: str) -> DataFrame:
    """One row per key as row-by-row upserting would leave it.

    The first row of a key is the insert; later ones only overwrite ``update`` columns.
    """
    columns = [c for c in source.columns if c != order]
    # A null order is neither first nor last; rows of equal order go by their content.
    content = [F.col(c) for c in columns]
    place = F.col(order)
    first = F.min_by(F.struct(*columns), F.struct(place.isNull(), place, *content))
    last = F.max_by(F.struct(*update), F.struct(place.isNotNull(), place, *content))
    folded = source.groupBy(F.col(key).alias("_key")).agg(first.alias("_first"), last.alias("_last"))
    return folded.select(
        *[F.col(f"_{'last' if c in update else 'first'}.{c}").alias(c) for c in columns]
    )


def entity_rows(entities: DataFrame, as_of: dt.datetime, *extra: str) -> DataFrame:
    """Clean entities in the stored layout; null and synthetic keys are skipped.

    ``extra`` names further columns to carry along.
    """
    carried = entities.select("*", *[F.col(c).alias(f"_x_{c}") for c in extra])
    rows = schemas.conform(carried, schemas.ENTITIES, keep_extra=bool(extra)).filter(real_key())
    now = F.lit(as_of).cast("timestamp_ntz")
    return rows.select(
        F.col("lei").alias("id"), "lei",
        F.coalesce("legal_name", F.lit("")).alias("legal_name"),
        F.coalesce("normalized_name", F.lit("")).alias("normalized_name"),
        "country", "jurisdiction", "entity_status", "registration_status",
        pack_legal_address().alias("legal_address"),
        pack_hq_address().alias("headquarters_address"),
        "managing_lou",
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        now.alias("created_at"), now.alias("updated_at"),
        *[F.col(f"_x_{c}").alias(c) for c in extra],
    )


def upsert_entities(stored: DataFrame, entities: DataFrame, as_of: dt.datetime,
                    small_source: bool = False) -> DataFrame:
    """Next entity snapshot: names, statuses and addresses follow the newest load.

    Rows that repeat a key are folded as if stored one by one, in the order of
    ``ingest_ord`` where the load has it, else of their content.
    """
    if "ingest_ord" in entities.columns:
        rows = entity_rows(entities, as_of, "ingest_ord")
    else:
        rows = entity_rows(entities, as_of).withColumn("ingest_ord", F.lit(0))
    rows = fold_source(rows, "lei", ENTITY_UPDATES, "ingest_ord")
    return merge_snapshot(stored, rows, "lei", ENTITY_UPDATES, small_source)


def new_rows(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key: append these.

    Of rows that share a key the earliest stays, then the best scored, then the first
    by the columns that can be ordered.
    """
    types = dict(incoming.dtypes)
    rest = [c for c in sorted(types) if c not in (key, "created_at", "final_score")
            and not types[c].startswith(("map", "variant"))]
    order = [F.asc_nulls_last("created_at")] if "created_at" in types else []
    order += [F.desc_nulls_last("final_score")] if "final_score" in types else []
    once = first_per_key(incoming, [key], *order, *[F.asc_nulls_last(c) for c in rest], F.asc(key))
    return once.join(stored.select(key), key, "left_anti").select(*incoming.columns)
