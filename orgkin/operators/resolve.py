"""Labelled duplicates, pair scoring and batch resolution."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin import schemas
from orgkin.functions import scoring as S
from orgkin.operators.keyed import exact_sample, first_per_key, keyed_join

_SIDE = (
    "lei", "legal_name", "normalized_name", "legal_address_line1", "legal_address_city",
    "country", "jurisdiction",
)
NOISE_KINDS = ("suffix", "abbreviation", "typo", "case", "punctuation")


def _draw(digest: Column, at: int) -> Column:
    """32-bit number from 8 hex digits of a digest, starting at a 1-based position."""
    return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")


def _replace_first(name: Column, word: str, by: Column) -> Column:
    at = F.locate(word, name)
    return F.concat(
        F.substring(name, F.lit(1), at - 1), by,
        F.substring(name, at + len(word), F.length(name)),
    )


def noise_mark(identity: Sequence[Column], seed: int = R.DUPLICATE_SEED) -> Column:
    """What the noise of a row is drawn from."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in identity]
    return F.concat_ws(":", *parts, F.lit(f"noise{seed}"))


def noise_kind(mark: Column) -> Column:
    """The kind of noise drawn for a mark; a name it does not apply to got the fallback."""
    return F.element_at(
        F.array(*[F.lit(k) for k in NOISE_KINDS]), (_draw(F.md5(mark), 1) % 5 + 1).cast("int")
    )


def noisy_name(name: Column | str, identity: Column) -> Column:
    """One of five kinds of noise, chosen by a hash of ``identity``.

    A kind that does not apply to the name falls back to adding or removing ' LLC'.
    """
    x = F.col(name) if isinstance(name, str) else name
    digest = F.md5(identity)
    kind, choice = _draw(digest, 1) % 5, _draw(digest, 9) % 3
    spot, coin = _draw(digest, 17), _draw(digest, 25) % 2

    suffix = F.lit(None).cast("string")
    for word, forms in reversed(R.NOISE_SUFFIXES):
        form = F.element_at(F.array(*[F.lit(f) for f in forms]), (choice + 1).cast("int"))
        suffix = F.when(F.contains(x, F.lit(word)), _replace_first(x, word, form)).otherwise(suffix)

    abbreviation = F.lit(None).cast("string")
    for word, short in reversed(R.NOISE_ABBREVIATIONS):
        abbreviation = F.when(
            F.contains(x, F.lit(word)), _replace_first(x, word, F.lit(short))
        ).otherwise(abbreviation)

    at = (spot % F.when(F.length(x) > 4, F.length(x) - 2) + 2).cast("int")
    letter = F.lower(F.substring(x, at, F.lit(1)))
    typed = F.concat(letter, letter)
    for ch, out in R.NOISE_TYPOS:
        typed = F.when(letter == ch, F.lit(out)).otherwise(typed)
    typo = F.when(
        F.length(x) > 4,
        F.concat(F.substring(x, F.lit(1), at - 1), typed, F.substring(x, at + 1, F.length(x))),
    )

    case = F.when(coin == 1, F.upper(x)).otherwise(F.lower(x))
    punct = F.translate(x, ",.", "")
    fallback = F.when(F.endswith(x, F.lit("LLC")), F.rtrim(x, F.lit(" LC"))).otherwise(
        F.concat(x, F.lit(" LLC"))
    )
    picked = (
        F.when(kind == 0, suffix).when(kind == 1, abbreviation).when(kind == 2, typo)
        .when(kind == 3, case).when(kind == 4, punct)
    )
    return F.coalesce(picked, fallback)


def labelled_duplicates(
    raw: DataFrame,
    n: int | None = None,
    seed: int = R.DUPLICATE_SEED,
    identity: tuple[str, ...] = ("lei", "ingest_ord"),
    first_by: str | None = None,
) -> DataFrame:
    """Noisy copies of all raw rows, or of a sample of ``n``, under a marked key.

    ``origin_lei`` keeps the true key for evaluation. ``first_by`` keeps only the first
    named row per key before any noise is made, for callers that clean the copies by
    that order anyway.
    """
    named = raw.filter(F.col("legal_name").isNotNull())
    if first_by is not None:
        named = first_per_key(named, ["lei"], F.asc_nulls_last(first_by))
    rows = named if n is None else exact_sample(named, n, seed, identity)
    mark = noise_mark([F.col(c) for c in identity], seed)
    return rows.withColumns(
        {
            "legal_name": noisy_name("legal_name", mark),
            "origin_lei": F.col("lei"),
            "lei": F.concat(F.lit(R.SYNTHETIC_PREFIX), F.coalesce("lei", F.lit(""))),
            "source": F.lit("synthetic"),
        }
    )


def pair_rows(
    real: DataFrame,
    dup: DataFrame,
    vectors: DataFrame | None = None,
    last_by: str | None = None,
    **join_options,
) -> DataFrame:
    """Equi-join of marked rows with the real row they name, as a_/b_ columns.

    ``vectors`` (one per lei) are attached where known, before the pairs are formed:
    both sides are still laid out by their own key then, so the pairs themselves are
    never shuffled for it. ``last_by`` names the order in which the last real row of
    a repeated key wins; leave it out when keys are already unique, as after cleaning.
    """
    names = set(real.columns)
    real = real.withColumns({c: F.lit(None).cast("string") for c in _SIDE if c not in names})
    if last_by is not None:
        real = first_per_key(real, ["lei"], F.desc_nulls_last(last_by))
    carried = list(_SIDE)
    if vectors is not None:
        known = vectors.select("lei", F.col("embedding").alias("vector"))
        real = real.join(known, "lei", "left")
        dup = keyed_join(dup, known, "lei", "left", **join_options)
        carried.append("vector")
    a = real.filter(F.col("lei").isNotNull()).select(
        F.col("lei").alias("_key"), *[F.col(c).alias(f"a_{c}") for c in carried]
    )
    extra = [c for c in ("ingest_ord",) if c in dup.columns]
    b = dup.select(
        F.replace(F.col("lei"), F.lit(R.SYNTHETIC_PREFIX), F.lit("")).alias("_key"),
        *[F.col(c).alias(f"b_{c}") for c in carried], *extra,
    )
    return keyed_join(b, a, "_key", **join_options).drop("_key")


def score_pairs(
    pairs: DataFrame,
    as_of: dt.datetime | None = None,
    renormalise_missing: bool = False,
) -> DataFrame:
    """Match records of a_/b_ pairs: signals, score, decision and reason codes."""
    text = pairs.withColumns(
        {
            "_addr_a": S.address_text("a_legal_address_line1", "a_legal_address_city"),
            "_addr_b": S.address_text("b_legal_address_line1", "b_legal_address_city"),
        }
    )
    signals = S.with_signals(
        text, ("a_normalized_name", "b_normalized_name"), ("_addr_a", "_addr_b"),
        ("a_vector", "b_vector") if "a_vector" in pairs.columns else None,
    ).withColumns(
        {
            "country_match": S.same_code("a_country", "b_country"),
            "jurisdiction_match": S.same_code("a_jurisdiction", "b_jurisdiction"),
        }
    )
    if "a_vector" not in pairs.columns:
        signals = signals.withColumn("embedding_similarity", F.lit(0.0))
        missing = F.lit(True)
    else:
        missing = F.col("a_vector").isNull() | F.col("b_vector").isNull()
    scored = signals.withColumn(
        "_total", S.score_raw(missing if renormalise_missing else None)
    ).withColumn("final_score", S.round_exact("_total", 4))
    return scored.select(
        S.match_id("a_lei", "b_lei").alias("id"),
        F.col("a_lei").alias("lei_a"), F.col("b_lei").alias("lei_b"),
        F.col("a_legal_name").alias("name_a"), F.col("b_legal_name").alias("name_b"),
        *R.WEIGHTS, "final_score",
        S.decide("final_score").alias("decision"),
        S.reason_codes().alias("reason_codes"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
    )


def resolve(
    real: DataFrame,
    dup: DataFrame,
    vectors: DataFrame | None = None,
    as_of: dt.datetime | None = None,
    last_by: str | None = None,
    renormalise_missing: bool = False,
) -> DataFrame:
    """Score every marked duplicate against the record it names; all decisions are kept."""
    pairs = pair_rows(real, dup, vectors, last_by)
    return score_pairs(pairs, as_of, renormalise_missing)


def compare(
    pairs: DataFrame, stored: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """Score chosen (lei_a, lei_b) pairs of the stored entity table."""
    flat = stored.select(
        "lei", "legal_name", "normalized_name",
        F.col("legal_address.line1").alias("legal_address_line1"),
        F.col("legal_address.city").alias("legal_address_city"),
        "country", "jurisdiction",
    )
    return score_pairs(side_rows(pairs, flat), as_of)


def side_rows(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """Chosen (lei_a, lei_b) pairs with both records, one per lei, as a_/b_ columns."""
    rows = pairs.select(F.col("lei_a").alias("a_lei"), F.col("lei_b").alias("b_lei"))
    for side in ("a", "b"):
        look = entities.select(*[F.col(c).alias(f"{side}_{c}") for c in _SIDE])
        rows = keyed_join(rows, look, f"{side}_lei")
    return rows


def unknown_keys(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """Requested keys that are not in the stored table."""
    asked = pairs.select(F.explode(F.array("lei_a", "lei_b")).alias("lei")).distinct()
    return asked.join(stored.select("lei"), "lei", "left_anti")


def empty_matches(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.MATCHES)
