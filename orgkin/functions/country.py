"""Country text to ISO alpha-2."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgkin.functions.text import _col, ascii_fold, literal_map, strip
from orgkin.refdata import COUNTRY_ALIASES, iso_countries


def country_key(c: Column) -> Column:
    """Upper-case ASCII words, '&' read as AND, other punctuation and a leading THE ignored."""
    x = F.regexp_replace(F.upper(ascii_fold(c)), "['`\u2019]", "")
    x = F.regexp_replace(x, "&", " AND ")
    x = F.trim(F.regexp_replace(x, "[^A-Z]+", " "))
    return F.regexp_replace(x, "^THE ", "")


@lru_cache(maxsize=1)
def _lookups() -> tuple[dict[str, str], dict[str, str]]:
    import re
    import unicodedata

    alpha3, names = {}, {}
    for two, three, name in iso_countries():
        alpha3[three] = two
        plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
        key = re.sub("[^A-Z]+", " ", plain.upper().replace("&", " AND ")).strip()
        names[key] = two
    for alias, two in COUNTRY_ALIASES.items():
        names.setdefault(alias, two)
    return alpha3, names


def normalize_country(c: Column | str) -> Column:
    """Two letters pass; then alpha-3, name or alias, unique name prefix; else 2 characters.

    "A, B" is also read as "B A", then as "A" alone.
    The lookup tables are literals of fixed size, so no join enters the plan.
    Null becomes ''.
    """
    code = F.upper(strip(F.coalesce(_col(c), F.lit(""))))
    return F.coalesce(known_country(c), F.substring(code, 1, 2))


def known_country(c: Column | str) -> Column:
    """The same, but null where only the first two characters would be left."""
    alpha3, names = _lookups()
    code = F.upper(strip(F.coalesce(_col(c), F.lit(""))))
    key = country_key(code)
    two_parts = F.contains(code, F.lit(","))
    before = country_key(F.substring_index(code, ",", 1))
    swapped = country_key(F.regexp_replace(code, r"^([^,]*),(.*)$", "$2 $1"))
    by_name = literal_map(names)
    starts = F.array_distinct(
        F.transform(
            F.filter(F.map_entries(by_name), lambda r: F.startswith(r["key"], key)),
            lambda r: r["value"],
        )
    )
    by_prefix = F.when(
        (F.length(key) > 2) & (F.size(starts) == 1), F.try_element_at(starts, F.lit(1))
    )
    return F.when(F.length(code) <= 2, code).otherwise(
        F.coalesce(
            F.when(F.length(code) == 3, F.try_element_at(literal_map(alpha3), code)),
            F.try_element_at(by_name, key),
            F.when(two_parts, F.try_element_at(by_name, swapped)),
            F.when(two_parts, F.try_element_at(by_name, before)),
            by_prefix,
        )
    )


def country_names() -> list[tuple[str, str]]:
    """(code, key) of every country name and alias, a few hundred of them."""
    return [(code, key) for key, code in _lookups()[1].items()]


def country_in_text(c: Column | str) -> Column:
    """Code of the longest country name or alias that occurs as whole words, or null."""
    _, names = _lookups()
    ordered = sorted(names.items(), key=lambda item: (-len(item[0]), item[0]))
    rows = F.map_entries(literal_map({f" {n} ": code for n, code in ordered}))
    text = F.concat(F.lit(" "), country_key(_col(c)), F.lit(" "))
    return F.try_element_at(F.filter(rows, lambda r: F.contains(text, r["key"])), F.lit(1))["value"]
