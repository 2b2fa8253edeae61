"""Personal data replaced by surrogates, with DataFrame functions only.

Entities are found by one pattern. A keyed hash of the normalised entity draws a surrogate
of the same type and format: digits stay digits, letters stay letters of their script and
case, cards that pass the check digit still do, given names keep their gender. All distinct
entities of the corpus are in one table: surrogates that collide with each other or with an
entity that exists are drawn again, so different entities stay different, and the same one
is replaced alike everywhere, however it is punctuated. Where so many entities of a shape
exist that draws keep failing, those left over change places among themselves.

Only distinct entities and the documents that hold some are shuffled; the text of all other
documents passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import documents, written

KEY = "surrogate-key-1"  # for tests and examples; whoever knows the key can redo the draws
ROUNDS = 10  # draws before what is left over changes places

# --- Fixed values: common given names by gender and script -----------------------------
GIVEN = {
    "given_m": (
        "James Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony "
        "Donald Steven Andrew Joshua Kenneth Kevin Brian Jürgen Wolfgang Klaus Heinz Pierre Jacques "
        "Philippe François Antonio Manuel Carlos Javier John Peter Paul George Edward Ronald Timothy "
        "Jason Jeffrey Ryan Jacob Nicholas Eric Jonathan Stephen Benjamin Samuel Gregory Alexander "
        "Patrick Dennis Hans Stefan Andreas Markus Jean Alain Laurent José Miguel Pedro Luis"
    ).split(),
    "given_f": (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret "
        "Sandra Ashley Kimberly Emily Michelle Ursula Sabine Monika Petra Renate Nathalie Isabelle "
        "Sylvie Catherine Françoise Carmen Josefa Isabel Dolores Pilar Jane Anna Maria Laura Helen "
        "Nicole Emma Rachel Julie Christine Deborah Angela Amy Kathleen Martha Victoria Hannah "
        "Claudia Andrea Birgit Martine Valérie Lucía Marta Elena Teresa Ana Rosa"
    ).split(),
    "given_cyr_m": "Иван Сергей Дмитрий Алексей Михаил Николай Андрей Владимир".split(),
    "given_cyr_f": "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
}
# --- Fixed values: titles before a name -------------------------------------------------
TITLES = r"Mr\.?|Mrs\.?|Ms\.?|Miss|Dr\.|Prof\.|Herr|Frau|Monsieur|Madame|Mme\.?|Mlle\.?|Señor|Señora|Sr\.|Sra\."
# --- Fixed values: alphabets and syllables of surrogates --------------------------------
LATIN, CYRILLIC, GREEK = (
    "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνοπρστυφχψω",
)
SYLLABLES = {
    "surname": "bal bren cor dal den fal gar hol kel lan lor mar mor nel nor pel ral ros sel tor val ver wen wil".split(),
    "surname_cyr": "бар вол гор дан зор кор лев мир нов рос сол тар хол чер шол яр".split(),
    "surname_gr": "αρ βελ γαλ δημ θεο καλ λεο μαν νικ παπ ραλ σταθ".split(),
}

NAME_WORD = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)*"
_given = "|".join(n for names in GIVEN.values() for n in names)
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+",
    "secret": (
        r"(?<=(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
        r"[A-Za-z0-9_/+\-]{8,}={0,2}"
        r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])"
        r"|(?<![A-Za-z0-9])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])"
    ),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": (
        r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
    ),
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": (
        r"(?<![\d+])\+\d{1,3}[ .\-]?\(\d{1,4}\)[ .\-]?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}(?!\d)"
        r"|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
        r"|(?<![\d+])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)|(?<![\d+.\-])\d{3}[ .\-]\d{3}[ .\-]\d{4}(?![\d\-])"
    ),
    "card": r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)",
    "name": (
        rf"(?<![\p{{L}}\p{{N}}])(?:(?:{TITLES}) {NAME_WORD}(?: {NAME_WORD}){{0,2}}"
        rf"|(?:{_given})(?: (?:{_given}|\p{{Lu}}\.)){{0,2}} {NAME_WORD})"
    ),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheap looks before the long pattern: characters, then shapes, that every entity has.
CHARACTERS = "[@0-9:=]"
SHAPES = r"@|\d[\d .()\-]{6,}|[:=]\s{0,3}[\"']?[A-Za-z0-9_/+\-]{8}|[0-9a-f]{32}|AKIA|gh[opsu]_|sk-"
NAMES = rf"(?=\p{{Lu}})(?:(?:{TITLES}) \p{{Lu}}|(?:{_given}) \p{{Lu}})"
MARK, ESCAPE = "\x01", "\x02"
DIGITS = ("card", "phone", "ssn")


def _marked(text: Column) -> Column:
    """The text with MARK around each entity; marks of its own are escaped."""
    safe = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "#")), F.lit(MARK), F.lit(ESCAPE + "!"))
    likely = (text.rlike(CHARACTERS) & text.rlike(SHAPES)) | text.rlike(NAMES)
    return F.when(likely, F.regexp_replace(safe, ANY, f"{MARK}$0{MARK}")).otherwise(safe)


def _unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "!"), F.lit(MARK)), F.lit(ESCAPE + "#"), F.lit(ESCAPE))


def _kind(entity: Column) -> Column:
    """The first pattern that fits the whole entity; the words of a secret's place are gone."""
    out = F.when(entity.contains("@"), "email")
    for kind in ("ip", "ssn", "phone", "card", "iban", "name"):
        out = out.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("secret")


def _parts(entity: Column) -> Column:
    """``kind, norm`` of what is replaced in an entity; a name has one for each word.

    Titles stay, so the gender they tell stays; given names outside the lists are replaced
    like surnames, which have none. An initial is a letter with a dot. A name is found by a
    title, or by a given name of the lists with given names or initials after it, then a surname.
    """
    kind = _kind(entity)
    title = rf"^(?:{TITLES})$"

    def word(w):
        of = F.when(w.rlike(title), "title")
        for name, names in GIVEN.items():
            of = of.when(w.isin(*names), name)
        of = of.when(w.rlike(r"^\p{Lu}\.$"), "initial")
        of = of.when(w.rlike(r"\p{IsCyrillic}"), "surname_cyr").when(w.rlike(r"\p{IsGreek}"), "surname_gr")
        return F.struct(of.otherwise("surname").alias("kind"), w.alias("norm"))

    names = F.filter(F.transform(F.split(entity, " "), word), lambda p: p["kind"] != "title")
    norm = (
        F.when(kind.isin(*DIGITS), F.regexp_replace(entity, r"[^\d+]", ""))
        .when(kind == "email", F.lower(entity)).when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .otherwise(entity)
    )
    return F.when(kind == "name", names).otherwise(
        F.array(F.struct(kind.alias("kind"), norm.alias("norm")))
    )


def _stream(key: str, *salt: Column) -> Column:
    """256 hex digits that depend on the key and the salt."""
    base = _keyed(key, F.concat_ws("|", *salt))
    return F.concat(*[F.sha2(F.concat(base, F.lit(f"|{i}")), 256) for i in range(4)])


def _keyed(key: str, text: Column) -> Column:
    """A keyed hash: the key goes in before and after an inner one."""
    inner = F.sha2(F.concat(F.lit(f"{key}|in|"), text), 256)
    return F.sha2(F.concat(F.lit(f"{key}|out|"), inner), 256)


def _number(stream: Column, at: Column) -> Column:
    """A number up to 65,535 for a place."""
    return F.conv(F.substr(stream, F.pmod(at * 4, F.lit(253)).cast("int") + 1, F.lit(4)), 16, 10).cast("int")


def _like(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Every digit and letter drawn anew, of the same script and case."""
    def one(c, i):
        n = _number(stream, i)
        def of(alphabet, k=None):
            k = F.lit(len(alphabet)) if k is None else k
            return F.substr(F.lit(alphabet), F.pmod(n, k).cast("int") + 1, F.lit(1))
        low = F.lower(c)
        letter = (
            F.when(low.rlike(r"\p{IsCyrillic}"), of(CYRILLIC)).when(low.rlike(r"\p{IsGreek}"), of(GREEK))
            .otherwise(of(LATIN, F.when(hexadecimal, 6).otherwise(len(LATIN))))
        )
        return (
            F.when(c.rlike(r"\d"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike(r"\p{L}"), F.when(c.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter))
            .otherwise(c)
        )
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule over digits, the last one included; divisible by 10 if right."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")
    ).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(places, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))


def _surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    stream = _stream(key, kind, norm, attempt.cast("string"))
    no = F.lit(False)
    like = _like(norm, stream, norm.rlike("^[0-9a-f]+$") & (kind == "secret"))
    domain = F.regexp_extract(norm, r"@(.+)\.[^.]+$", 1)
    email = F.concat(
        _like(F.regexp_extract(norm, "^([^@]+)@", 1), stream, no), F.lit("@"),
        _like(domain, F.reverse(stream), no), F.regexp_extract(norm, r"(\.[^.]+)$", 1),
    )
    ip = F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_number(stream, i), F.lit(254)) + 1).cast("string")
    ), ".")
    first = F.regexp_extract(norm, r"^\+?\d", 0)  # the country or the card's network
    numeric = F.concat(first, _like(F.substr(norm, F.length(first) + 1), stream, no))
    body = F.substr(numeric, F.lit(1), F.length(numeric) - 1)
    right = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    card = F.when(F.pmod(_luhn(norm), F.lit(10)) == 0, F.concat(body, right.cast("string"))).otherwise(numeric)
    iban = F.concat(F.substr(norm, F.lit(1), F.lit(2)), _like(F.substr(norm, F.lit(3)), stream, no))
    out = (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
        .when(kind.isin("phone", "ssn"), numeric).when(kind == "iban", iban)
    )
    for name, names in GIVEN.items():
        # A keyed rotation: given names of the list stay different and never stay themselves.
        turn = int.from_bytes(f"{key}{name}".encode(), "big") % (len(names) - 1) + 1
        where = F.array_position(F.array(*map(F.lit, names)), norm).cast("int") - 1
        out = out.when(kind == name, F.get(F.array(*map(F.lit, names)), (where + turn) % len(names)))
    for name, syllables in SYLLABLES.items():
        out = out.when(kind == name, F.initcap(_syllables(stream, syllables, attempt)))
    letter = _like(norm, stream, no)
    return out.when(kind == "initial", letter).otherwise(like)


def _syllables(stream: Column, syllables: list[str], attempt: Column) -> Column:
    """Three drawn syllables, and more after failed attempts."""
    table = F.array(*map(F.lit, syllables))
    places = F.sequence(F.lit(0), 2 + F.floor(attempt / 2).cast("int"))
    drawn = F.transform(places, lambda i: F.get(
        table, F.pmod(_number(stream, i), F.lit(len(syllables))).cast("int")
    ))
    return F.array_join(drawn, "")


def surrogates(parts: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, norm`` -> the distinct ones with ``surrogate``, all different within a kind
    and none equal to its own ``norm``.

    Nor to another one of that kind, as long as draws succeed: each round draws again for
    those that collide; the first by attempt and text keeps a surrogate that several have
    drawn. What still collides after ROUNDS draws is of a shape whose forms are nearly all
    taken; these change places in a keyed order, within the shape. The lists of given
    names are turned instead, and initials, which are no identity, are drawn once.
    """
    made = lambda df: written(
        df.withColumn("surrogate", _surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "pii-surrogates"
    )
    free = F.col("kind").startswith("given") | (F.col("kind") == "initial")
    now = made(parts.select("kind", "norm").distinct().withColumn("attempt", F.lit(0)))
    originals = now.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("exists"))
    for left in reversed(range(ROUNDS)):
        turn = F.row_number().over(W.partitionBy("kind", "surrogate").orderBy("attempt", "norm"))
        seen = now.withColumn("turn", turn).join(originals, ["kind", "surrogate"], "left")
        clash = ~free & ((F.col("turn") > 1) | F.coalesce("exists", F.lit(False)))
        seen = seen.select("kind", "norm", "attempt", "surrogate", clash.alias("clash"))
        if seen.filter("clash").isEmpty():
            return now.select("kind", "norm", "surrogate")
        if left:
            now = made(seen.select("kind", "norm", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt")))
    seen = written(seen, "pii-surrogates")
    return seen.filter("NOT clash").select("kind", "norm", "surrogate").unionByName(
        _exchanged(seen.filter("clash").select("kind", "norm"), key)
    )


def _exchanged(left: DataFrame, key: str) -> DataFrame:
    """Each entity gets the next one's text, in a keyed order round the entities of its shape.

    One that is alone with its shape goes round with the others that are alone in its kind,
    and one that is alone there gets its keyed hash.
    """
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("norm", r"\d", "9"), r"\p{Lu}", "A"), r"\p{Ll}", "a")
    order = _keyed(key, F.concat_ws("|", "kind", "norm"))

    def round_of(rows: DataFrame, *group: str) -> DataFrame:
        own = W.partitionBy(*group).orderBy("_order", "norm")
        return rows.withColumns({
            "_next": F.coalesce(F.lead("norm").over(own), F.first("norm").over(own)),
            "_many": F.count(F.lit(1)).over(W.partitionBy(*group)),
        })

    rows = round_of(left.withColumns({"_shape": shape, "_order": order}), "kind", "_shape")
    alone = round_of(rows.filter("_many = 1").drop("_next", "_many"), "kind")
    own = F.when(F.col("_many") > 1, F.col("_next")).otherwise(F.substring("_order", 1, 24))
    return rows.filter("_many > 1").select("kind", "norm", F.col("_next").alias("surrogate")).unionByName(
        alone.select("kind", "norm", own.alias("surrogate"))
    )


def _written_like(entity: Column, surrogate: Column, kind: Column) -> Column:
    """The surrogate with the punctuation of this mention: its n-th character that counts
    takes the place of the entity's n-th."""
    chars = F.split(entity, "")
    at = lambda i: F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), F.when(kind == "iban", " ").otherwise(r"[^\d+]"), ""))
    spread = F.array_join(F.transform(
        chars, lambda c, i: F.when(c.rlike(r"[A-Za-z\d+]"), F.substr(surrogate, at(i).cast("int"), F.lit(1))).otherwise(c)
    ), "")
    return F.when(kind.isin(*DIGITS, "iban"), spread).otherwise(surrogate)


def _replaced(entity: Column, known: Column) -> Column:
    """The entity with its surrogates; ``known``: map of kind|norm to surrogate."""
    parts = _parts(entity)
    get = lambda p: F.element_at(known, F.concat(p["kind"], F.lit("|"), p["norm"]))
    kind = _kind(entity)
    title = F.regexp_extract(entity, rf"^(?:{TITLES}) ", 0)
    first = F.get(parts, 0)
    return F.when(kind == "name", F.concat(title, F.array_join(F.transform(parts, get), " "))).otherwise(
        _written_like(entity, get(first), kind)
    )


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with their own columns, ``text`` with surrogates drawn by ``key``, which
    should be a secret of the corpus.

    A null text stays null and a text without personal data stays as it is. Equal rows get
    equal texts; ids may be null or repeat. ``n_chars``, where it is a column, is set to the
    new length of a text that changed. An empty table gives no rows.
    """
    return _with_surrogates(docs, key).drop("_pii_count")


def _with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    row = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.lit(1))
    hit = docs.withColumn("_pii_pieces", F.split(_marked(F.col("text")), MARK))
    found = hit.filter(F.size("_pii_pieces") > 1).select(
        row.alias("_pii_row"),
        F.explode(F.array_distinct(F.flatten(F.transform(
            F.filter("_pii_pieces", lambda p, i: i % 2 == 1), _parts
        )))).alias("part"),
    ).select("_pii_row", "part.kind", "part.norm").distinct()
    found = written(found, "pii-found")
    table = surrogates(found, key)
    known = found.join(table, ["kind", "norm"]).groupBy("_pii_row").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat("kind", F.lit("|"), "norm"), "surrogate")
    )).alias("_pii_known"))
    changed = hit.filter(F.size("_pii_pieces") > 1).withColumn("_pii_row", row).join(known, "_pii_row")
    new = _unescaped(F.array_join(F.transform("_pii_pieces", lambda p, i: F.when(
        i % 2 == 1, _replaced(p, F.col("_pii_known"))
    ).otherwise(p)), ""))
    changed = changed.withColumn("_pii_text", new)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_pii_text").alias("text"))
        elif c == "n_chars":
            columns.append(F.length("_pii_text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    count = F.floor(F.size("_pii_pieces") / 2).cast("long").alias("_pii_count")
    same = docs.filter(
        F.col("text").isNull() | (F.size(F.split(_marked(F.col("text")), MARK)) == 1)
    ).withColumn("_pii_count", F.lit(0).cast("long"))
    return same.unionByName(changed.select(*columns, count))


def query(spark, sf_dir):
    """``doc_id``, the text with surrogates, how many entities it had."""
    out = _with_surrogates(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_pii_count").alias("n_entities"))
