"""Vocabularies, rewrite rules and scoring constants."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession

SYNTHETIC_PREFIX = "SYNTH_"
DEFAULT_SOURCE = "GLEIF"

# --- Fixed values: registry column names -> canonical names --------------------------
REGISTRY_COLUMNS = {
    "LEI": "lei",
    "Entity.LegalName": "legal_name",
    "Entity.OtherEntityNames": "other_names",
    "Entity.LegalAddress.FirstAddressLine": "legal_address_line1",
    "Entity.LegalAddress.City": "legal_address_city",
    "Entity.LegalAddress.Country": "country",
    "Entity.LegalAddress.PostalCode": "legal_address_postal",
    "Entity.HeadquartersAddress.FirstAddressLine": "hq_address_line1",
    "Entity.HeadquartersAddress.City": "hq_address_city",
    "Entity.HeadquartersAddress.Country": "hq_country",
    "Entity.LegalJurisdiction": "jurisdiction",
    "Entity.EntityStatus": "entity_status",
    "Registration.InitialRegistrationDate": "initial_registration_date",
    "Registration.LastUpdateDate": "last_update_date",
    "Registration.RegistrationStatus": "registration_status",
    "Registration.ManagingLOU": "managing_lou",
}

# --- Fixed values: watchlist schemas kept by the scan, and sampling sizes ------------
WATCHLIST_SCHEMAS = ("Company", "Organization", "LegalEntity")
REGISTRY_SEED = 42
DUPLICATE_SAMPLE = 5_000
DUPLICATE_SEED = 99

# --- Fixed values: legal-form rewrites, applied in this order, ignoring case ---------
LEGAL_FORMS = (
    (r"\bincorporated\b", "Inc"),
    (r"\binc\.\b", "Inc"),
    (r"\bcorporation\b", "Corp"),
    (r"\bcorp\.\b", "Corp"),
    (r"\blimited\b", "Ltd"),
    (r"\bltd\.\b", "Ltd"),
    (r"\bl\.l\.c\.?\b", "LLC"),
    (r"\bn\.a\.?\b", "NA"),
    (r"\bplc\b", "PLC"),
    (r"\bgmbh\b", "GmbH"),
    (r"\bag\b", "AG"),
    (r"\bs\.a\.\b", "SA"),
    (r"\bb\.v\.\b", "BV"),
    (r"\bn\.v\.\b", "NV"),
    (r"\bco\.\b", "Co"),
    (r"\bcompany\b", "Co"),
)

# --- Fixed values: address word abbreviations, applied in this order -----------------
ADDRESS_WORDS = (
    ("street", "St"),
    ("avenue", "Ave"),
    ("boulevard", "Blvd"),
    ("drive", "Dr"),
    ("road", "Rd"),
    ("suite", "Ste"),
    ("floor", "Fl"),
    ("north", "N"),
    ("south", "S"),
    ("east", "E"),
    ("west", "W"),
)

# --- Fixed values: status vocabularies ------------------------------------------------
ENTITY_STATUSES = (
    "ACTIVE", "INACTIVE", "MERGED", "RETIRED", "ANNULLED",
    "DUPLICATE", "TRANSFERRED", "PENDING_TRANSFER", "PENDING_ARCHIVAL",
)
REGISTRATION_STATUSES = (
    "ISSUED", "LAPSED", "MERGED", "RETIRED", "ANNULLED",
    "DUPLICATE", "TRANSFERRED", "PENDING_TRANSFER", "PENDING_ARCHIVAL",
    "PENDING_VALIDATION",
)
UNKNOWN_STATUS = "UNKNOWN"

# --- Fixed values: country codes a valid record may carry ----------------------------
VALID_COUNTRIES = (
    "AF", "AL", "DZ", "AD", "AO", "AG", "AR", "AM", "AU", "AT", "AZ", "BS", "BH", "BD",
    "BB", "BY", "BE", "BZ", "BJ", "BT", "BO", "BA", "BW", "BR", "BN", "BG", "BF", "BI",
    "CV", "KH", "CM", "CA", "CF", "TD", "CL", "CN", "CO", "KM", "CG", "CD", "CR", "HR",
    "CU", "CY", "CZ", "DK", "DJ", "DM", "DO", "EC", "EG", "SV", "GQ", "ER", "EE", "SZ",
    "ET", "FJ", "FI", "FR", "GA", "GM", "GE", "DE", "GH", "GR", "GD", "GT", "GN", "GW",
    "GY", "HT", "HN", "HU", "IS", "IN", "ID", "IR", "IQ", "IE", "IL", "IT", "JM", "JP",
    "JO", "KZ", "KE", "KI", "KP", "KR", "KW", "KG", "LA", "LV", "LB", "LS", "LR", "LY",
    "LI", "LT", "LU", "MG", "MW", "MY", "MV", "ML", "MT", "MH", "MR", "MU", "MX", "FM",
    "MD", "MC", "MN", "ME", "MA", "MZ", "MM", "NA", "NR", "NP", "NL", "NZ", "NI", "NE",
    "NG", "NO", "OM", "PK", "PW", "PA", "PG", "PY", "PE", "PH", "PL", "PT", "QA", "RO",
    "RU", "RW", "KN", "LC", "VC", "WS", "SM", "ST", "SA", "SN", "RS", "SC", "SL", "SG",
    "SK", "SI", "SB", "SO", "ZA", "SS", "ES", "LK", "SD", "SR", "SE", "CH", "SY", "TW",
    "TJ", "TZ", "TH", "TL", "TG", "TO", "TT", "TN", "TR", "TM", "TV", "UG", "UA", "AE",
    "GB", "US", "UY", "UZ", "VU", "VE", "VN", "YE", "ZM", "ZW",
)

# --- Fixed values: name noise for labelled duplicates --------------------------------
NOISE_SUFFIXES = (
    ("Inc.", ("Inc", "Incorporated", "INC")),
    ("Corp.", ("Corp", "Corporation", "CORP")),
    ("Ltd.", ("Ltd", "Limited", "LTD")),
    ("LLC", ("L.L.C.", "L.L.C", "Llc")),
    ("N.A.", ("NA", "N.A", "National Association")),
    ("Co.", ("Co", "Company", "CO")),
)
NOISE_ABBREVIATIONS = (
    ("Street", "St."),
    ("Avenue", "Ave."),
    ("Boulevard", "Blvd."),
    ("Drive", "Dr."),
    ("Road", "Rd."),
    ("North", "N."),
    ("South", "S."),
    ("East", "E."),
    ("West", "W."),
)
NOISE_TYPOS = (("a", "aa"), ("e", "ee"), ("i", "ii"), ("o", "oo"), ("n", "m"), ("m", "n"))

# --- Fixed values: score weights, decision lines and reason-code lines ---------------
WEIGHTS = {
    "name_similarity": 0.35,
    "address_similarity": 0.25,
    "embedding_similarity": 0.20,
    "country_match": 0.10,
    "jurisdiction_match": 0.10,
}
TOKEN_SORT_SHARE = 0.6
PARTIAL_SHARE = 0.4
SAME_AT = 0.85
REVIEW_AT = 0.65
SAME, REVIEW, DIFFERENT = "same_entity", "needs_review", "different_entity"
LINKED_DECISIONS = (SAME, REVIEW)
REASONS = (
    ("name_similarity", 0.85, "similar_name"),
    ("address_similarity", 0.80, "similar_address"),
    ("embedding_similarity", 0.85, "similar_embedding"),
    ("country_match", 1.0, "same_country"),
    ("jurisdiction_match", 1.0, "same_jurisdiction"),
)
REVIEWER_DECISIONS = ("accepted", "rejected")

# Names people write that are neither the display name nor a prefix of it.
COUNTRY_ALIASES = {
    "UNITED STATES OF AMERICA": "US", "AMERICA": "US",
    "GREAT BRITAIN": "GB", "BRITAIN": "GB", "ENGLAND": "GB", "SCOTLAND": "GB", "WALES": "GB",
    "UNITED KINGDOM OF GREAT BRITAIN AND NORTHERN IRELAND": "GB",
    "RUSSIAN FEDERATION": "RU", "REPUBLIC OF KOREA": "KR", "KOREA REPUBLIC OF": "KR",
    "HOLLAND": "NL", "CZECH REPUBLIC": "CZ", "TURKIYE": "TR", "IVORY COAST": "CI",
    "VIET NAM": "VN", "HONG KONG": "HK", "MACAO": "MO", "MACAU": "MO", "BURMA": "MM",
    "MYANMAR": "MM", "SWAZILAND": "SZ", "CABO VERDE": "CV", "HOLY SEE": "VA",
    "BRUNEI DARUSSALAM": "BN", "SLOVAK REPUBLIC": "SK", "REPUBLIC OF IRELAND": "IE",
    "PALESTINE": "PS", "STATE OF PALESTINE": "PS", "SYRIAN ARAB REPUBLIC": "SY",
    "LAO PEOPLES DEMOCRATIC REPUBLIC": "LA", "DEMOCRATIC PEOPLES REPUBLIC OF KOREA": "KP",
    "DEMOCRATIC REPUBLIC OF THE CONGO": "CD", "REPUBLIC OF THE CONGO": "CG",
    "FEDERATED STATES OF MICRONESIA": "FM", "ISLAMIC REPUBLIC OF IRAN": "IR",
}


@lru_cache(maxsize=1)
def iso_countries() -> tuple[tuple[str, str, str], ...]:
    """(alpha-2, alpha-3, English name) of every ISO 3166-1 country.

    Taken from the JVM's own locale data, so the table is not repeated here.
    """
    spark = SparkSession.getActiveSession()
    locale = spark._jvm.java.util.Locale
    rows = []
    for code in locale.getISOCountries():
        entry = locale("", code)
        rows.append((code, entry.getISO3Country(), entry.getDisplayCountry(locale.ENGLISH)))
    return tuple(rows)
