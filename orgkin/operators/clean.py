"""Whole-table cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin.functions.country import normalize_country
from orgkin.functions.text import (
    blank_to_null, normalize_address, normalize_name, standardize_status, strip,
)
from orgkin.operators.keyed import first_per_key, first_rows, spread
from orgkin.refdata import ENTITY_STATUSES, REGISTRATION_STATUSES


def clean_columns(df: DataFrame, strict_suffixes: bool = False) -> DataFrame:
    """Normalise every known column that is present; no row is dropped."""
    have = set(df.columns)
    rules = {
        "legal_name": lambda: strip(F.coalesce("legal_name", F.lit(""))),
        "legal_address_line1": lambda: normalize_address("legal_address_line1"),
        "hq_address_line1": lambda: normalize_address("hq_address_line1"),
        "country": lambda: normalize_country("country"),
        "hq_country": lambda: normalize_country("hq_country"),
        "entity_status": lambda: standardize_status("entity_status", ENTITY_STATUSES),
        "registration_status": lambda: standardize_status(
            "registration_status", REGISTRATION_STATUSES
        ),
    }
    new = {c: rule() for c, rule in rules.items() if c in have}
    if "legal_name" in have:
        new["normalized_name"] = normalize_name("legal_name", strict_suffixes)
    return df.withColumns(new)


def dedupe_first(df: DataFrame, order: str = "ingest_ord", reread: bool = False) -> DataFrame:
    """Keep the first row per lei in ingest order; rows without a lei are one group.

    A small input is dealt over all cores by key, which the window then reuses. ``reread`` finds
    the first rows before the others are widened, for inputs that are cheap to read twice.
    """
    if reread:
        return first_rows(df, "lei", order)
    return first_per_key(spread(df, "lei"), ["lei"], F.asc_nulls_last(order))


def clean_entities(
    df: DataFrame, order: str = "ingest_ord", strict_suffixes: bool = False, reread: bool = False
) -> DataFrame:
    """Keep the first filing per lei, then normalise it.

    Deduplicating first gives the same rows, as no rule touches the key, and the
    expressions run once per entity instead of once per filing.
    """
    rows = dedupe_first(df, order, reread) if "lei" in df.columns else df
    return clean_columns(rows, strict_suffixes)


def stage_boundary(df: DataFrame) -> DataFrame:
    """Blank strings become null, the form in which every later operator expects them."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: blank_to_null(c) for c in text})
