import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgkin.functions import text as X
from orgkin.functions.country import country_in_text, normalize_country
from orgkin.refdata import LEGAL_FORMS, REGISTRATION_STATUSES


def values(spark, items, *cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x string")
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(cols)]).orderBy("i").collect()
    return [r.c0 if len(cols) == 1 else tuple(r)[1:] for r in rows]


def test_company_names(spark):
    got = values(
        spark,
        ["APPLE INC", "Acme Incorporated", "Some Company L.L.C.", "Company Name,", "Company   Name",
         "", None, "J.P. MORGAN CHASE BANK, N.A.", "Müller Corporation.X", "société s.a. x"],
        X.normalize_name("x"),
    )
    assert got == ["Apple Inc", "Acme Inc", "Some Co LLC.", "Co Name", "Co Name", "", "",
                   "J.P. Morgan Chase Bank NA.", "Muller CorpX", "Societe S.A. X"]


def test_rewrites_agree_with_running_every_rule(spark):
    """The stem test only skips rules that could not match."""
    words = ["inc.", "Incorporated", "corp.x", "Corporation.", "l.l.c", "N.A.", "Co.", "company",
             "tag", "AG", "b.v.", "B.V.x", "plc", "incx", "s.a.r", "ltd.", "Limited", "a"]
    items = [f"{a} {b}{c}" for a in words for b in words for c in ("", ".", ",x")]
    want = []
    for text in items:
        for rule, form in LEGAL_FORMS:
            text = re.sub(rule, form, text, flags=re.IGNORECASE)
        want.append(text)
    assert values(spark, items, X.legal_forms("x")) == want


def test_strict_suffixes_take_the_final_dot(spark):
    got = values(spark, ["Some Company L.L.C.", "Acme Inc.", "Bank, N.A.", "Tag Co."],
                 X.normalize_name("x", strict_suffixes=True))
    assert got == ["Some Co LLC", "Acme Inc", "Bank NA", "Tag Co"]


def test_addresses(spark):
    got = values(spark, ["123 Market Street", "", None, " 5 north  MAIN avenue, suite 4 ",
                         "Straße 1 weststreet"], X.normalize_address("x"))
    assert got == ["123 Market St", "", "", "5 N Main Ave, Ste 4", "Straße 1 Weststreet"]


def test_dots(spark):
    assert values(spark, ["N.A.", "Company Name,", None, "a.b.c , "], X.drop_dots("x")) == [
        "NA.", "Company Name", "", "abc"]


def test_countries(spark):
    got = values(spark, ["US", "us", "USA", "Germany", "XX", "", None, "NA", "Côte d’Ivoire",
                         "russian federation", "Germ", "Qqq", "united"], normalize_country("x"))
    assert got == ["US", "US", "US", "DE", "XX", "", "", "NA", "CI", "RU", "DE", "QQ", "UN"]


def test_country_in_text(spark):
    got = values(spark, ["banks in South Africa", "Nigeria oil", "Niger oil", "nothing here"],
                 country_in_text("x"))
    assert got == ["ZA", "NG", "NE", None]


def test_statuses(spark):
    assert values(spark, ["ACTIVE", "active", "BANANA", None, " pending transfer", "Pending-Archival"],
                  X.standardize_status("x")) == [
        "ACTIVE", "ACTIVE", "UNKNOWN", "UNKNOWN", "PENDING_TRANSFER", "PENDING_ARCHIVAL"]
    assert values(spark, ["issued", "INACTIVE"],
                  X.standardize_status("x", REGISTRATION_STATUSES)) == ["ISSUED", "UNKNOWN"]


letters = st.text(
    alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=30
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(letters, min_size=100, max_size=200))
def test_fold_and_spaces_agree_with_python(spark, items):
    got = values(spark, items, X.ascii_fold("x"), X.collapse_spaces("x"), X.strip("x"))
    for text, (folded, collapsed, stripped) in zip(items, got):
        assert folded == unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        assert collapsed == " ".join(text.split())
        assert stripped == text.strip()


def test_fold_of_every_character(spark):
    """All code points with a decomposition, plus those of the first planes without one."""
    chars = [chr(i) for i in range(1, 0x30000)
             if not 0xD800 <= i <= 0xDFFF and (i < 0x3000 or unicodedata.decomposition(chr(i)))]
    lines = ["".join(chars[i:i + 50]) for i in range(0, len(chars), 50)]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in lines]
    assert values(spark, lines, X.ascii_fold("x")) == want


def test_title_case_agrees_with_python(spark):
    items = ["o'NEIL 3m J.P. smith-JONES", "straße ßa ǆx éCOLE 中a ªb", "ΟΔΟΣ ΣΑΣ", "", "a1b_c"]
    assert values(spark, items, X.title_case("x")) == [t.title() for t in items]


def test_blank_to_null(spark):
    assert values(spark, [" ", "", None, " a "], X.blank_to_null("x")) == [None, None, None, "a"]
    assert values(spark, ["a"], F.lit("x")) == ["x"]


def test_country_names_of_the_standard(spark):
    from orgkin.functions.country import normalize_country

    expected = {
        "Moldova, Republic of": "MD", "Congo, The Democratic Republic of the": "CD",
        "Brunei Darussalam": "BN", "Slovak Republic": "SK", "The Netherlands": "NL",
        "Republic of Ireland": "IE", "Tanzania, United Republic of": "TZ",
        "Taiwan, Province of China": "TW", "Palestine, State of": "PS", "Côte d'Ivoire": "CI",
        "Côte d’Ivoire": "CI", "Korea, Republic of": "KR", "Iran, Islamic Republic of": "IR",
        "Virgin Islands, British": "VG", "Germany": "DE", "DEU": "DE", "": "",
    }
    rows = spark.createDataFrame([(n,) for n in expected], "n string")
    got = {r.n: r.c for r in rows.select("n", normalize_country("n").alias("c")).collect()}
    assert got == expected
