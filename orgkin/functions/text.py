"""Name, address and status normalisation as Column expressions."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgkin.refdata import ADDRESS_WORDS, ENTITY_STATUSES, LEGAL_FORMS, UNKNOWN_STATUS


def _ranges(chars: str) -> str:
    """Regex class body of the characters, neighbours merged into ranges."""
    spans: list[list[int]] = []
    for i in sorted(map(ord, chars)):
        if spans and spans[-1][1] == i - 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)


# Every code point Python calls white space: one set for trimming and collapsing.
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
_SPACE_RUN = "[" + _ranges(WHITESPACE) + "]+"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_CASE_RUN = f"([{_CASED}]+|[^{_CASED}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def collapse_spaces(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), _SPACE_RUN, " "))


def literal_map(table: dict[str, str]) -> Column:
    """Constant map column, folded once by the optimizer."""
    text = "\x02".join(f"{k}\x01{v}" for k, v in table.items())
    return F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01"))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """ASCII forms of non-ASCII characters under compatibility decomposition."""
    src, dst, longer = [], [], {}
    for i in range(128, sys.maxunicode + 1):
        ch = chr(i)
        if not unicodedata.decomposition(ch):
            continue
        ascii_form = "".join(x for x in unicodedata.normalize("NFKD", ch) if x < "\x80")
        if len(ascii_form) == 1:
            src.append(ch)
            dst.append(ascii_form)
        elif ascii_form:
            longer[ch] = ascii_form
    return "".join(src), "".join(dst), longer


def ascii_fold(c: Column | str) -> Column:
    """Decompose accents and compatibility forms, then drop what is not ASCII."""
    x = _col(c)
    src, dst, longer = _fold_tables()
    table = literal_map(longer)
    plain = F.translate(x, src, dst)
    spelled = F.array_join(
        F.transform(F.split(plain, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)),
        "",
    )
    wide = r"[^\x00-\x7F]"
    # most text is ASCII, most of the rest is after one translate; only what is left is spelled
    return F.when(
        x.rlike(wide), F.when(plain.rlike(wide), F.regexp_replace(spelled, wide, "")).otherwise(plain)
    ).otherwise(x)


def title_case(c: Column | str) -> Column:
    """Capital after every uncased character, not only after a space."""
    runs = F.regexp_extract_all(_col(c), F.lit(_CASE_RUN), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def _strict_stem(pattern: str) -> str:
    for tail in (r"\.?\b", r"\.\b", r"\b"):
        if pattern.endswith(tail):
            return pattern[: -len(tail)]
    return pattern


def _strict(pattern: str) -> str:
    """Rule variant that also consumes a closing dot at the end of the name."""
    stem = _strict_stem(pattern)
    dot = r"\.?" if pattern != stem + r"\b" else ""
    return stem + dot + r"(?!\w)"


def _rewrite(x: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Apply (stem, pattern, form) rewrites in order.

    A rule's regex runs only on text that contains its stem, in any case, so most
    rules cost one substring test.
    """
    lines = [{"stem": s, "rule": p, "form": f} for s, p, f in rules]
    table = F.from_json(
        F.lit(json.dumps(lines)), "array<struct<stem:string,rule:string,form:string>>"
    )
    return F.aggregate(
        table, x,
        lambda text, r: F.when(
            F.contains(F.lower(F.upper(text)), r["stem"]), F.regexp_replace(text, r["rule"], r["form"])
        ).otherwise(text),
    )


def _stem(pattern: str) -> str:
    """The fixed lower-case text any match of a legal-form pattern contains."""
    return pattern.replace(r"\b", "").replace(r"\.?", "").replace(r"\.", ".")


def legal_forms(c: Column | str, strict_suffixes: bool = False) -> Column:
    return _rewrite(
        _col(c),
        [(_stem(_strict_stem(p) if strict_suffixes else p),
          f"(?i){_strict(p) if strict_suffixes else p}", form) for p, form in LEGAL_FORMS],
    )


def normalize_name(c: Column | str, strict_suffixes: bool = False) -> Column:
    """Company name: ASCII, title case, short legal form, no commas; null becomes ''."""
    x = title_case(strip(ascii_fold(F.coalesce(_col(c), F.lit("")))))
    x = F.translate(legal_forms(x, strict_suffixes), ",", "")
    return collapse_spaces(x)


def drop_dots(c: Column | str) -> Column:
    """Remove dots between letters and a closing comma; null becomes ''."""
    x = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?<=[A-Za-z])\.(?=[A-Za-z])", "")
    return strip(F.regexp_replace(x, f",(?:{_SPACE_RUN})?$", ""))


def normalize_address(c: Column | str) -> Column:
    """Address line: title case and abbreviated street words; null becomes ''."""
    x = title_case(strip(F.coalesce(_col(c), F.lit(""))))
    rules = [(word, rf"(?iU)\b{word}\b", short) for word, short in ADDRESS_WORDS]
    return collapse_spaces(_rewrite(x, rules))


def standardize_status(c: Column | str, vocabulary=ENTITY_STATUSES) -> Column:
    code = F.translate(F.upper(strip(c)), " -", "__")
    return F.when(code.isin(*vocabulary), code).otherwise(F.lit(UNKNOWN_STATUS))
