"""Pair signals, weighted score, decision and reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin.functions import align as A
from orgkin.functions.align import partial_ratio, token_set_ratio, token_sort_ratio
from orgkin.functions.numeric import round_exact
from orgkin.functions.text import _col, blank_to_null, strip
from orgkin.operators.keyed import spread


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _both(a: Column, b: Column, value: Column) -> Column:
    return F.when(_filled(a) & _filled(b), value).otherwise(F.lit(0.0))


def name_raw(a: Column | str, b: Column | str) -> Column:
    """Weighted name similarity before rounding; a blank side scores 0."""
    a, b = _col(a), _col(b)
    blend = R.TOKEN_SORT_SHARE * token_sort_ratio(a, b) + R.PARTIAL_SHARE * partial_ratio(a, b)
    return _both(a, b, blend)


def address_raw(a: Column | str, b: Column | str) -> Column:
    """Word-set similarity before rounding; a blank side scores 0."""
    a, b = _col(a), _col(b)
    return _both(a, b, token_set_ratio(a, b))


def address_text(line1: Column | str, city: Column | str) -> Column:
    return F.concat_ws(" ", blank_to_null(line1), blank_to_null(city))


def same_code(a: Column | str, b: Column | str) -> Column:
    """1 when both codes are present and equal ignoring case and outer space, else 0."""
    a, b = F.upper(strip(a)), F.upper(strip(b))
    return F.when(_filled(a) & _filled(b) & (a == b), F.lit(1.0)).otherwise(F.lit(0.0))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    parts = F.zip_with(
        _col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def norm(a: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(_col(a), F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    )


def cosine_raw(a: Column | str, b: Column | str) -> Column:
    """Cosine before rounding; null when a vector is missing."""
    a, b = _col(a), _col(b)
    return dot(a, b) / (norm(a) * norm(b) + F.lit(1e-9))


def with_signals(
    df: DataFrame,
    name: tuple[str, str] | None = None,
    address: tuple[str, str] | None = None,
    vector: tuple[str, str] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Add name_similarity, address_similarity and embedding_similarity, 4 dp.

    Words, alignments, raw values and their rounding are projections of their own, so
    each step reads columns instead of repeating the one before, and a filter on a
    similarity stays above the alignment. Small inputs are dealt over all cores
    first, as alignment is the costliest step of a run; ``dealt`` rows stay where they are,
    such as pairs that a join of small inputs made by the million.
    """
    c = F.col
    words, parts, sides, aligned, raw, rounded = {}, {}, {}, {}, {}, {}
    if name:
        words |= {f"_name_{s}": A.sorted_words(n) for s, n in zip("ab", name)}
        aligned |= {"_name_lcs": A.lcs_length_once("_name_a", "_name_b"), "_name_window": A.window_ratio_once(*name)}
        blend = R.TOKEN_SORT_SHARE * A.ratio(c("_name_lcs"), c("_name_a"), c("_name_b")) + R.PARTIAL_SHARE * c("_name_window")
        raw["_name_raw"] = _both(c(name[0]), c(name[1]), blend)
        rounded["name_similarity"] = round_exact("_name_raw", 4)
    if address:
        words |= {f"_words_{s}": A.tokens(n) for s, n in zip("ab", address)}
        parts = dict(zip(("_both", "_only_a", "_only_b"), A.set_parts(c("_words_a"), c("_words_b")), strict=True))
        sides = {f"_side_{s}": A.set_side(c("_both"), c(f"_only_{s}")) for s in "ab"}
        aligned["_side_lcs"] = A.lcs_length_once("_side_a", "_side_b")
        made = A.set_ratio(*[c(n) for n in ("_words_a", "_words_b", *parts, *sides, "_side_lcs")])
        raw["_address_raw"] = _both(c(address[0]), c(address[1]), made)
        rounded["address_similarity"] = round_exact("_address_raw", 4)
    if vector:
        raw["_vector_raw"] = cosine_raw(*vector)
        rounded["embedding_similarity"] = F.greatest(
            F.lit(0.0), F.coalesce(round_exact("_vector_raw", 4), F.lit(0.0))
        )
    used = [n for pair in (name, address) if pair for n in pair]
    rows = spread(df, *used) if used and not dealt else df
    steps = [s for s in (words, parts, sides, aligned, raw) if s]
    for step in [*steps, rounded]:
        rows = rows.withColumns(step)
    return rows.drop(*[n for s in steps for n in s])


def score_raw(vector_missing: Column | None = None) -> Column:
    """Weighted sum of the signal columns of a row before rounding.

    ``vector_missing`` marks rows whose vector weight is spread over the other
    signals; by default a missing vector just contributes 0.
    """
    w = R.WEIGHTS
    total = F.col("name_similarity") * w["name_similarity"]
    for signal in list(w)[1:]:
        total = total + F.col(signal) * w[signal]
    if vector_missing is not None:
        rest = sum(v for k, v in w.items() if k != "embedding_similarity")
        total = F.when(vector_missing, total / F.lit(rest)).otherwise(total)
    return total


def decide(score: Column | str) -> Column:
    score = _col(score)
    return (
        F.when(score >= R.SAME_AT, F.lit(R.SAME))
        .when(score >= R.REVIEW_AT, F.lit(R.REVIEW))
        .otherwise(F.lit(R.DIFFERENT))
    )


def reason_codes() -> Column:
    """Codes of the signals that reached their line, from the signal columns of a row."""
    return F.array_compact(
        F.array(*[F.when(F.col(c) >= line, F.lit(code)) for c, line, code in R.REASONS])
    )


def match_id(lei_a: Column | str, lei_b: Column | str) -> Column:
    """Stable pair id, so a rerun never stores the same pair twice."""
    return F.sha2(F.concat_ws(":", _col(lei_a), _col(lei_b)), 256)
