"""DuckDB SQL that recomputes the registered queries from the driver tables."""

from __future__ import annotations

from checks import views as V
from orgkin import refdata as R

AS_OF, EARLIER = "TIMESTAMP '2024-06-01'", "TIMESTAMP '2024-05-01'"
PROBE_KEY = "LEI" + "7".rjust(17, "0")


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def rounded(x: str, digits: int) -> str:
    """Half-even rounding of the exact binary value of a double expression."""
    scale, split = f"{10**digits}::DOUBLE", f"{2**27 + 1}::DOUBLE"
    high = f"({x} * {split} - ({x} * {split} - {x}))"
    product = f"({x} * {scale})"
    error = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    beyond = f"(({product} - floor({product}) - 0.5::DOUBLE) + {error})"
    up = f"({beyond} > 0 OR ({beyond} = 0 AND floor({product}) % 2 = 1))"
    return f"((floor({product}) + CASE WHEN {up} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / {scale})"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def title(x: str, letters: str = "A-Za-z") -> str:
    runs = f"regexp_extract_all({x}, '([{letters}]+|[^{letters}]+)')"
    word = "CASE t[1] WHEN 'ß' THEN 'Ss' ELSE upper(t[1]) END || lower(t[2:])"
    return f"array_to_string(list_transform({runs}, lambda t: {word}), '')"


def name(x: str, strict: bool = False) -> str:
    out = title(fold(f"trim(coalesce({x}, ''))"))
    for pattern, form in R.LEGAL_FORMS:
        if strict:
            # no lookahead in this engine: keep the character that ends the word
            stem = pattern
            for tail in (r"\.?\b", r"\.\b", r"\b"):
                if stem.endswith(tail):
                    stem = stem[: -len(tail)]
                    break
            dot = r"\.?" if stem != pattern[: -len(r"\b")] else ""
            out = f"regexp_replace({out}, '{stem}{dot}($|[^\\w])', '{form}\\1', 'gi')"
        else:
            out = f"regexp_replace({out}, '{pattern}', '{form}', 'gi')"
    return collapse(f"replace({out}, ',', '')")


def address(x: str) -> str:
    out = title(f"trim(coalesce({x}, ''))")
    for word, short in R.ADDRESS_WORDS:
        out = f"regexp_replace({out}, '\\b{word}\\b', '{short}', 'gi')"
    return collapse(out)


def status(x: str, words) -> str:
    code = f"translate(upper(trim({x})), ' -', '__')"
    return f"CASE WHEN {code} IN ({quoted(words)}) THEN {code} ELSE 'UNKNOWN' END"


ISO = (
    "iso AS (SELECT unnest(string_split('{n},{a3}', ',')) AS said, "
    "unnest(string_split('{c},{c}', ',')) AS code)"
).format(n=V.NATION_NAMES.upper(), a3=V.NATION_CODES3, c=V.NATION_CODES)


def country(x: str) -> str:
    code = f"upper(trim(coalesce({x}, '')))"
    return (
        f"CASE WHEN length({code}) <= 2 THEN {code} ELSE "
        f"coalesce((SELECT any_value(code) FROM iso WHERE said = {code}), {code}[1:2]) END"
    )


RAW = f"raw AS ({V.duck_view(V.RAW)})"


def cleaned(out: str, source: str, strict_key: bool = True) -> str:
    """CTEs ``out``: cleaned rows of ``source`` with blanks as null, first per lei if asked."""
    first = (
        f"{out}_first AS (SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY lei ORDER BY ingest_ord) = 1)" if strict_key
        else f"{out}_first AS (SELECT * FROM {source})"
    )
    return f"""{first},
{out} AS (SELECT * REPLACE (
  {blank('legal_name')} AS legal_name, {blank('other_names')} AS other_names,
  {blank(address('legal_address_line1'))} AS legal_address_line1,
  {blank(address('hq_address_line1'))} AS hq_address_line1,
  {blank(country('country'))} AS country, {blank(country('hq_country'))} AS hq_country,
  {blank('jurisdiction')} AS jurisdiction,
  {status('entity_status', R.ENTITY_STATUSES)} AS entity_status,
  {status('registration_status', R.REGISTRATION_STATUSES)} AS registration_status),
  {blank(name('legal_name'))} AS normalized_name FROM {out}_first)"""


def noise() -> str:
    """CTEs ``dup_raw``: the noisy copy of every named filing."""
    def draw(at: int) -> str:
        return f"concat('0x', substr(h, {at}, 8))::BIGINT"

    def swap(word: str, by: str) -> str:
        at = f"strpos(legal_name, '{word}')"
        return (f"substr(legal_name, 1, {at} - 1) || {by} || "
                f"substr(legal_name, {at} + {len(word)})")

    suffix = " ".join(
        f"WHEN contains(legal_name, '{w}') THEN {swap(w, f'([{quoted(f)}])[choice + 1]')}"
        for w, f in R.NOISE_SUFFIXES
    )
    short = " ".join(
        f"WHEN contains(legal_name, '{w}') THEN {swap(w, quoted([s]))}"
        for w, s in R.NOISE_ABBREVIATIONS
    )
    typed = " ".join(f"WHEN '{c}' THEN '{o}'" for c, o in R.NOISE_TYPOS)
    letter = "lower(substr(legal_name, spot, 1))"
    return f"""dn AS (SELECT *, md5(coalesce(lei, '') || ':' || ingest_ord || ':noise99') AS h
  FROM raw WHERE legal_name IS NOT NULL),
dk AS (SELECT *, {draw(1)} % 5 AS kind, {draw(9)} % 3 AS choice, {draw(25)} % 2 AS coin,
  CASE WHEN length(legal_name) > 4 THEN {draw(17)} % (length(legal_name) - 2) + 2 END AS spot
  FROM dn),
dx AS (SELECT *, coalesce(CASE kind
  WHEN 0 THEN CASE {suffix} END
  WHEN 1 THEN CASE {short} END
  WHEN 2 THEN CASE WHEN length(legal_name) > 4 THEN substr(legal_name, 1, spot - 1)
    || CASE {letter} {typed} ELSE {letter} || {letter} END || substr(legal_name, spot + 1) END
  WHEN 3 THEN CASE WHEN coin = 1 THEN upper(legal_name) ELSE lower(legal_name) END
  ELSE replace(replace(legal_name, ',', ''), '.', '') END,
  CASE WHEN suffix(legal_name, 'LLC') THEN rtrim(legal_name, ' LC')
       ELSE legal_name || ' LLC' END) AS noisy FROM dk),
dup_raw AS (SELECT * EXCLUDE (h, kind, choice, coin, spot, noisy)
  REPLACE (noisy AS legal_name, 'SYNTH_' || coalesce(lei, '') AS lei),
  lei AS origin_lei, 'synthetic' AS source FROM dx)"""


REAL = cleaned("real", "raw")
DUP = noise() + ",\n" + cleaned("dup", "dup_raw")
NOISY = noise() + ",\n" + cleaned("noisy", "dup_raw", False)


def alignment(pairs: str, kinds: tuple[str, ...]) -> str:
    """CTE ``scores``: alignment ratios of the distinct (a, b) of ``pairs``.

    Bit i of a mask stands for character i of the needle; the reduction adds one
    text character at a time and the cleared bits count the common subsequence.
    """
    lcs = """CASE WHEN length(s) + length(t) = 0 THEN 1.0::DOUBLE ELSE
      2.0::DOUBLE * (length(s) - bit_count(list_reduce(lm, lambda x, u:
        ((x + (x & u)) | (x - (x & u))) & full_bits, full_bits)))
      / (length(s) + length(t)) END"""
    parts = []
    if "sort" in kinds:
        parts.append("SELECT id, 'sort' AS kind, array_to_string(ta, ' ') AS s, "
                     "array_to_string(tb, ' ') AS t FROM st")
    if "set" in kinds:
        parts += [
            "SELECT id, 'set', array_to_string(list_concat(i, x), ' '), "
            "array_to_string(list_concat(i, y), ' ') FROM st",
            "SELECT id, 'set', array_to_string(i, ' '), "
            "array_to_string(list_concat(i, x), ' ') FROM st WHERE len(i) > 0",
            "SELECT id, 'set', array_to_string(i, ' '), "
            "array_to_string(list_concat(i, y), ' ') FROM st WHERE len(i) > 0",
        ]
    if "part" in kinds:
        parts += [
            "SELECT id, 'part', a, b FROM p WHERE length(a) <= length(b)",
            "SELECT id, 'part', b, a FROM p WHERE length(b) < length(a) OR "
            "(length(b) = length(a) AND a <> b)",
        ]
    tok = "list_filter(string_split_regex(trim({0}), '\\s+'), lambda w: w <> '')"
    return f"""p AS (SELECT row_number() OVER () AS id, a, b FROM
  (SELECT DISTINCT a, b FROM {pairs} WHERE a <> '' AND b <> '')),
tok AS (SELECT id, list_sort({tok.format('a')}) AS ta, list_sort({tok.format('b')}) AS tb FROM p),
st AS (SELECT id, ta, tb,
  list_sort(list_distinct(list_filter(ta, lambda w: list_contains(tb, w)))) AS i,
  list_sort(list_distinct(list_filter(ta, lambda w: NOT list_contains(tb, w)))) AS x,
  list_sort(list_distinct(list_filter(tb, lambda w: NOT list_contains(ta, w)))) AS y FROM tok),
cmp(id, kind, s, t) AS ({' UNION ALL '.join(parts)}),
needle AS (SELECT DISTINCT s FROM cmp WHERE s <> ''),
mask AS (SELECT s, map_from_entries(list((ch, bits))) AS m FROM
  (SELECT s, s[j] AS ch, sum(1::HUGEINT << (j - 1))::HUGEINT AS bits
   FROM (SELECT s, unnest(range(1, length(s) + 1))::INT AS j FROM needle) GROUP BY 1, 2)
  GROUP BY s),
lined AS (SELECT id, kind, cmp.s, t, (1::HUGEINT << length(cmp.s)) - 1 AS full_bits,
  list_transform(string_split(t, ''), lambda ch: coalesce(m[ch], 0::HUGEINT)) AS masks
  FROM cmp LEFT JOIN mask ON cmp.s = mask.s),
win AS (SELECT id, kind, s, full_bits, masks AS lm, t FROM lined WHERE kind <> 'part'
  UNION ALL
  SELECT id, kind, s, full_bits, masks[greatest(k, 0) + 1 : least(k + length(s), length(t))] AS lm,
    t[greatest(k, 0) + 1 : least(k + length(s), length(t))] AS t
  FROM (SELECT *, unnest(range(1 - length(s), length(t))) AS k FROM lined WHERE kind = 'part')),
each AS (SELECT id, kind, {lcs} AS v FROM win),
best AS (SELECT id, max(v) FILTER (kind = 'sort') AS token_sort,
  max(v) FILTER (kind = 'part') AS partial, max(v) FILTER (kind = 'set') AS set_best
  FROM each GROUP BY id),
scores AS (SELECT p.a, p.b, token_sort, partial,
  CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE
       WHEN len(i) > 0 AND (len(x) = 0 OR len(y) = 0) THEN 1.0::DOUBLE
       ELSE set_best END AS token_set
  FROM best JOIN p USING (id) JOIN st USING (id))"""


NAME_MIX = "(0.6::DOUBLE * token_sort + 0.4::DOUBLE * partial)"


def name_scores(pairs: str) -> str:
    return f"""{alignment(pairs, ('sort', 'part'))},
name_scores AS (SELECT a, b, {rounded('mix', 4)} AS score FROM
  (SELECT a, b, {NAME_MIX} AS mix FROM scores))"""


def address_text(side: str) -> str:
    parts = f"{blank(f'{side}.legal_address_line1')}, {blank(f'{side}.legal_address_city')}"
    return f"concat_ws(' ', {parts})"


def same(a: str, b: str) -> str:
    a, b = f"upper(trim(coalesce({a}, '')))", f"upper(trim(coalesce({b}, '')))"
    return f"CASE WHEN {a} <> '' AND {a} = {b} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def pair_columns(a: str = "a", b: str = "b") -> str:
    """Signal inputs of a joined row, with every alignment text in one pair list later."""
    return f"""{a}.lei AS lei_a, {b}.lei AS lei_b, {a}.legal_name AS name_a,
  {b}.legal_name AS name_b, {a}.normalized_name AS na, {b}.normalized_name AS nb,
  {address_text(a)} AS aa, {address_text(b)} AS ab,
  {same(f'{a}.country', f'{b}.country')} AS country_match,
  {same(f'{a}.jurisdiction', f'{b}.jurisdiction')} AS jurisdiction_match"""


def scored(source: str, out: str = "matches", vector: bool = True, spread: bool = False) -> str:
    """CTEs ``out``: match records of joined rows ``source`` (see ``pair_columns``)."""
    raw_cos = (
        "CASE WHEN va IS NOT NULL AND vb IS NOT NULL THEN "
        "list_inner_product(va::DOUBLE[], vb::DOUBLE[]) / "
        "(sqrt(list_inner_product(va::DOUBLE[], va::DOUBLE[])) * "
        "sqrt(list_inner_product(vb::DOUBLE[], vb::DOUBLE[])) + 1e-9) END"
        if vector else "NULL::DOUBLE"
    )
    w = R.WEIGHTS
    total = " + ".join(f"{k} * {v}::DOUBLE" for k, v in w.items())
    if spread:
        total = f"({total}) / {sum(v for k, v in w.items() if k != 'embedding_similarity')}::DOUBLE"
    codes = ", ".join(
        f"CASE WHEN {c} >= {line}::DOUBLE THEN '{code}' END" for c, line, code in R.REASONS
    )
    texts = (
        f"texts AS (SELECT na AS a, nb AS b FROM {source} UNION SELECT aa, ab FROM {source})"
    )
    return f"""{texts},
{alignment('texts', ('sort', 'part', 'set'))},
sig AS (SELECT q.*, coalesce({rounded('n.mix', 4)}, 0) AS name_similarity,
  coalesce({rounded('d.token_set', 4)}, 0) AS address_similarity, {raw_cos} AS cos
  FROM {source} q
  LEFT JOIN (SELECT a, b, {NAME_MIX} AS mix FROM scores) n ON n.a = na AND n.b = nb
  LEFT JOIN scores d ON d.a = aa AND d.b = ab),
sig2 AS (SELECT *, greatest(0.0::DOUBLE, coalesce({rounded('cos', 4)}, 0)) AS embedding_similarity
  FROM sig),
tot AS (SELECT *, {total} AS total FROM sig2),
fin AS (SELECT *, {rounded('total', 4)} AS final_score FROM tot),
{out} AS (SELECT sha256(lei_a || ':' || lei_b) AS id, lei_a, lei_b, name_a, name_b,
  name_similarity, address_similarity, embedding_similarity, country_match, jurisdiction_match,
  final_score, CASE WHEN final_score >= {R.SAME_AT}::DOUBLE THEN '{R.SAME}'
    WHEN final_score >= {R.REVIEW_AT}::DOUBLE THEN '{R.REVIEW}' ELSE '{R.DIFFERENT}' END
    AS decision,
  list_filter([{codes}], lambda c: c IS NOT NULL) AS codes, {AS_OF} AS created_at FROM fin)"""


VECTORS = f"vec AS ({V.duck_view(V.VECTORS)})"
RESOLVED = f"""pairs AS (SELECT {pair_columns()}, v.embedding AS va, w.embedding AS vb
  FROM dup b JOIN real a ON a.lei = replace(b.lei, 'SYNTH_', '')
  LEFT JOIN vec v ON v.lei = a.lei LEFT JOIN vec w ON w.lei = b.lei)"""
BASE = f"{ISO},\n{RAW},\n{REAL}"
MATCHES = f"{BASE},\n{DUP},\n{VECTORS},\n{RESOLVED},\n{scored('pairs')}"

STORED = f"""stored AS (SELECT lei AS id, lei, coalesce(legal_name, '') AS legal_name,
  coalesce(normalized_name, '') AS normalized_name, country, jurisdiction, entity_status,
  registration_status, to_json({{'line1': legal_address_line1, 'city': legal_address_city,
    'postal': legal_address_postal}})::VARCHAR AS legal_address,
  to_json({{'line1': hq_address_line1, 'city': hq_address_city}})::VARCHAR
    AS headquarters_address,
  managing_lou, 'GLEIF' AS source, {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM real WHERE lei IS NOT NULL AND lei NOT LIKE 'SYNTH_%')"""
INDEX = """points AS (SELECT r.lei, coalesce(legal_name, '') AS legal_name,
  coalesce(normalized_name, '') AS normalized_name, coalesce(country, '') AS country,
  coalesce(jurisdiction, '') AS jurisdiction, coalesce(entity_status, '') AS entity_status,
  v.embedding::DOUBLE[] AS e,
  sqrt(list_inner_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])) AS norm
  FROM real r JOIN vec v ON r.lei = v.lei WHERE NOT starts_with(r.lei, 'SYNTH_'))"""
GRAPH = f"""owned AS ({V.duck_view(V.RELATIONSHIPS)}),
companies AS (SELECT lei AS id, legal_name AS label FROM real WHERE lei IS NOT NULL
  UNION ALL SELECT lei, legal_name FROM dup WHERE lei IS NOT NULL),
edges AS (
  SELECT DISTINCT lei AS src, country AS dst, 'LOCATED_IN' AS edge_type, 'Country' AS dst_type,
    NULL::DOUBLE AS final_score, NULL AS decision FROM real
    WHERE lei IS NOT NULL AND country IS NOT NULL
  UNION ALL SELECT DISTINCT lei, jurisdiction, 'REGISTERED_IN', 'Jurisdiction', NULL, NULL
    FROM real WHERE lei IS NOT NULL AND jurisdiction IS NOT NULL
  UNION ALL SELECT lei_a, lei_b, 'MATCHED_TO', 'Company', final_score, decision FROM matches
    WHERE decision IN ({quoted(R.LINKED_DECISIONS)})
      AND lei_a IN (SELECT id FROM companies) AND lei_b IN (SELECT id FROM companies)
  UNION ALL SELECT DISTINCT lei, parent_lei, 'HAS_' || relationship_type || '_PARENT', 'Company',
    NULL, NULL FROM owned WHERE relationship_type IN ('DIRECT', 'ULTIMATE')
      AND lei IN (SELECT id FROM companies) AND parent_lei IN (SELECT id FROM companies))"""
AROUND = """inc AS (
  SELECT DISTINCT src AS key, 'out' AS direction, edge_type, dst AS other,
    dst_type AS other_type FROM edges
  UNION ALL SELECT DISTINCT dst, 'in', edge_type, src, 'Company' FROM edges
    WHERE dst_type = 'Company'),
hood AS (
  SELECT id AS key, id AS other, 'Company' AS other_type, coalesce(label, id) AS label,
    0 AS step, '' AS edge_type FROM companies
  UNION ALL SELECT key, other, other_type, coalesce(c.label, other),
    CASE direction WHEN 'out' THEN 1 ELSE 2 END, edge_type FROM inc
    LEFT JOIN companies c ON other_type = 'Company' AND c.id = other),
hood1 AS (SELECT key, other AS id, label, other_type AS type FROM hood WHERE other <> ''
  QUALIFY row_number() OVER (PARTITION BY key, other
    ORDER BY step DESC, edge_type DESC, other_type DESC) = 1)"""
LINKS = """links AS (SELECT src AS key, edge_type AS rel_type,
  coalesce(c.label, dst) AS target_label,
  CASE WHEN dst_type = 'Company' THEN dst ELSE '' END AS target_lei, dst_type AS target_type
  FROM edges LEFT JOIN companies c ON dst_type = 'Company' AND c.id = dst)"""
REVIEWS = f"""reviews AS (SELECT sha256(lei || ':SYNTH_' || lei) AS id, decision, ts, seq
  FROM ({V.duck_view(V.REVIEW_EVENTS)})),
latest AS (SELECT id, decision AS reviewer_decision, ts AS reviewed_at FROM reviews
  WHERE decision IN ('accepted', 'rejected')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1)"""
RUNS = f"""runs AS (SELECT run_date, total_records, valid_records, {rounded('x', 2)}
  AS data_quality_score FROM (SELECT *, valid_records::DOUBLE / total_records * 100 AS x
    FROM ({V.duck_view(V.QUALITY_RUNS)})))"""
ISSUES = f"""issues AS (SELECT lei, unnest(list_filter([
  CASE WHEN coalesce(trim(legal_name), '') = '' THEN 'legal name is missing' END,
  CASE WHEN legal_address_line1 IS NULL THEN 'address is missing' END,
  CASE WHEN country NOT IN ({quoted(R.VALID_COUNTRIES)}) THEN 'country code is not accepted' END,
  CASE WHEN entity_status NOT IN ({quoted(R.ENTITY_STATUSES)})
    THEN 'entity status is not recognised' END], lambda i: i IS NOT NULL)) AS issue FROM real)"""
LISTED = f"""listed AS (SELECT lei, row_number() OVER (PARTITION BY lei
    ORDER BY final_score DESC, id) AS rank, id, final_score, name_b, lei_b
  FROM (SELECT lei_a AS lei, * FROM matches UNION ALL
        SELECT lei_b, * FROM matches WHERE lei_b <> lei_a)
  WHERE decision IN ({quoted(R.LINKED_DECISIONS)}) QUALIFY rank <= 20)"""


def metrics(source: str) -> str:
    ok = quoted(R.VALID_COUNTRIES)
    return f"""counts AS (SELECT count(*) AS total_records,
  count(*) FILTER (lei IS NOT NULL AND coalesce(trim(legal_name), '') <> ''
    AND (country IS NULL OR country IN ({ok}))) AS valid_records,
  count(*) FILTER (lei IS NULL) AS missing_lei_count,
  count(*) FILTER (legal_name IS NULL) AS missing_name_count,
  count(*) - count(DISTINCT coalesce(lei, '<none>')) AS duplicate_lei_count,
  count(*) FILTER (country NOT IN ({ok})) AS invalid_country_count,
  count(*) FILTER (entity_status NOT IN ({quoted(R.ENTITY_STATUSES)})) AS invalid_status_count,
  count(*) FILTER (legal_address_line1 IS NULL) AS no_address FROM {source}),
rates AS (SELECT *, missing_name_count::DOUBLE / total_records AS nr,
  no_address::DOUBLE / total_records AS ar, valid_records::DOUBLE / total_records * 100 AS q
  FROM counts),
metrics AS (SELECT total_records, valid_records, total_records - valid_records AS invalid_records,
  missing_lei_count, missing_name_count, duplicate_lei_count, invalid_country_count,
  invalid_status_count, {rounded('nr', 4)} AS missing_name_rate,
  {rounded('ar', 4)} AS missing_address_rate, {rounded('q', 2)} AS data_quality_score,
  missing_lei_count = 0 AS lei_not_null, missing_name_count = 0 AS legal_name_not_null,
  duplicate_lei_count = 0 AS no_duplicate_lei,
  1 - invalid_country_count::DOUBLE / total_records >= 0.95::DOUBLE
    AS country_valid_rate_above_95pct,
  no_address::DOUBLE / total_records <= 0.30::DOUBLE AS missing_address_below_30pct FROM rates)"""


def two(x: str) -> str:
    return f"printf('%.2f', {rounded(x, 2)})"


def upserted() -> str:
    """CTE ``merged``: open orders' customers renamed, all suppliers added."""
    load = f"""sup AS ({V.duck_view(V.SUPPLIER_RAW)}),
load AS (SELECT lei, coalesce(legal_name, '') || ' Renewed' AS legal_name, normalized_name,
    'ZZ' AS country, jurisdiction, 'INACTIVE' AS entity_status, registration_status,
    legal_address_line1 AS l1, legal_address_city AS lc, legal_address_postal AS lp,
    hq_address_line1 AS h1, hq_address_city AS hc, managing_lou FROM real
    WHERE lei IN (SELECT 'LEI' || lpad(o_custkey::VARCHAR, 17, '0') FROM orders
                  WHERE o_orderstatus = 'O')
  UNION ALL SELECT lei, legal_name, {name('legal_name')}, country, jurisdiction,
    {status('entity_status', R.ENTITY_STATUSES)}, registration_status,
    {address('legal_address_line1')}, legal_address_city, NULL, NULL, NULL, NULL FROM sup),
s AS (SELECT *, to_json({{'line1': l1, 'city': lc, 'postal': lp}})::VARCHAR AS la,
  to_json({{'line1': h1, 'city': hc}})::VARCHAR AS ha FROM load)"""
    return f"""{load},
merged AS (SELECT coalesce(t.id, s.lei) AS id, coalesce(t.lei, s.lei) AS lei,
  coalesce(s.legal_name, t.legal_name) AS legal_name,
  CASE WHEN s.lei IS NOT NULL THEN coalesce(s.normalized_name, '') ELSE t.normalized_name END
    AS normalized_name,
  CASE WHEN t.lei IS NOT NULL THEN t.country ELSE s.country END AS country,
  CASE WHEN t.lei IS NOT NULL THEN t.jurisdiction ELSE s.jurisdiction END AS jurisdiction,
  coalesce(s.entity_status, t.entity_status) AS entity_status,
  coalesce(s.registration_status, t.registration_status) AS registration_status,
  coalesce(s.la, t.legal_address) AS legal_address,
  coalesce(s.ha, t.headquarters_address) AS headquarters_address,
  CASE WHEN t.lei IS NOT NULL THEN t.managing_lou ELSE s.managing_lou END AS managing_lou,
  'GLEIF' AS source,
  CASE WHEN t.lei IS NOT NULL THEN {EARLIER} ELSE {AS_OF} END AS created_at,
  CASE WHEN s.lei IS NOT NULL THEN {AS_OF} ELSE {EARLIER} END AS updated_at
  FROM stored t FULL JOIN s ON t.lei = s.lei)"""


def top_k(k: int, queries: str, extra: str = "TRUE") -> str:
    """CTE ``found``: best k points per query (query_id, qv) with score and rank."""
    return f"""pts AS (SELECT q.query_id, p.*, list_inner_product(p.e, q.qv) /
    (sqrt(list_inner_product(q.qv, q.qv)) * p.norm + 1e-9) AS cos
  FROM points p JOIN {queries} q ON {extra}),
found AS (SELECT query_id, row_number() OVER (PARTITION BY query_id
    ORDER BY round(cos, 6) DESC, lei) AS rank, lei, legal_name, normalized_name, country,
    jurisdiction, entity_status, {rounded('cos', 4)} AS score FROM pts
  QUALIFY rank <= {k})"""


CENTROIDS = """parts AS (SELECT label, unnest(embedding)::DOUBLE AS v,
  unnest(range(len(embedding))) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(v) AS v FROM parts GROUP BY 1, 2),
centroids AS (SELECT label AS query_id, list(v ORDER BY pos) AS qv FROM means GROUP BY 1)"""

MATCH_COLUMNS = (
    "id, lei_a, lei_b, name_a, name_b, name_similarity, address_similarity, "
    "embedding_similarity, country_match, jurisdiction_match, final_score, decision, "
    "array_to_string(codes, ',') AS reason_codes, created_at"
)
EDGE_COLUMNS = "src, dst, edge_type, 'Company' AS src_type, dst_type, final_score, decision"
FILING_PAIRS = f"""fp AS (SELECT b.ingest_ord, {pair_columns()} FROM noisy b
  JOIN real a ON a.lei = replace(b.lei, 'SYNTH_', ''))"""
STORED_COLUMNS = (
    "id, lei, legal_name, normalized_name, country, jurisdiction, entity_status, "
    "registration_status, legal_address, headquarters_address, managing_lou, source, created_at"
)


def base_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    def add(key: str, ctes: str, select: str) -> None:
        o[key] = f"WITH {ctes}\n{select}" if ctes else select

    add("src_a1_registry_csv", RAW, f"""SELECT {blank('lei')} AS lei,
      {blank('legal_name')} AS legal_name, {blank('country')} AS country,
      {blank('jurisdiction')} AS jurisdiction, {blank('legal_address_line1')}
      AS legal_address_line1, initial_registration_date, managing_lou FROM raw""")
    add("src_a3_sample", RAW, """SELECT lei, ingest_ord FROM raw ORDER BY
      md5(coalesce(lei, '') || ':' || ingest_ord || ':42'), lei, ingest_ord LIMIT 5000""")
    lines = f"lines AS ({V.duck_view(V.WATCHLIST_LINES)})"
    good = f"""{lines}, good AS (SELECT value::JSON AS j FROM lines WHERE json_valid(value)
      AND trim(value) <> '')"""
    add("src_a5_watchlist", good, f"""SELECT j->>'$.id' AS os_id,
      coalesce(j->>'$.properties.name[0]', '') AS os_name,
      coalesce(j->>'$.properties.country[0]', '') AS os_country, j->>'$.schema' AS os_schema,
      array_to_string((j->>'$.datasets[*]'), ',') AS os_datasets FROM good
      WHERE j->>'$.schema' IN ({quoted(R.WATCHLIST_SCHEMAS)})""")
    add("src_a7_corrupt_lines", lines, """SELECT count(*) AS corrupt_lines FROM lines
      WHERE trim(value) <> '' AND NOT json_valid(value)""")

    add("norm_c1_company_name", RAW, f"SELECT ingest_ord, {name('legal_name')} AS name FROM raw")
    add("norm_c2_ascii_fold", "", f"SELECT doc_id, {fold('text')} AS folded FROM documents")
    letters = r"\p{Lu}\p{Ll}\p{Lt}"
    add("norm_c3_title_case", "",
        f"SELECT doc_id, {title('text', letters)} AS titled FROM documents")
    add("norm_c4_strict_suffixes", RAW,
        f"SELECT ingest_ord, {name('legal_name', True)} AS name FROM raw")
    add("norm_c5_collapse_spaces", "",
        f"SELECT doc_id, {collapse('text')} AS collapsed FROM documents")
    # a dot between letters: replaced twice, as matches that share a letter do not overlap
    dots = "coalesce(legal_name, '')"
    for _ in range(2):
        dots = f"regexp_replace({dots}, '([A-Za-z])\\.([A-Za-z])', '\\1\\2', 'g')"
    add("norm_c6_drop_dots", RAW, f"""SELECT ingest_ord,
      trim(regexp_replace({dots}, ',\\s*$', '')) AS name FROM raw""")
    add("norm_c7_address", RAW, f"""SELECT ingest_ord, {address('legal_address_line1')} AS legal,
      {address('hq_address_line1')} AS hq FROM raw""")
    add("norm_c8_country", f"{ISO}, {RAW}", f"""SELECT ingest_ord, {country('country')} AS country,
      {country('hq_country')} AS hq_country FROM raw""")
    add("norm_c9_status", RAW, f"""SELECT ingest_ord,
      {status('entity_status', R.ENTITY_STATUSES)} AS entity,
      {status('registration_status', R.REGISTRATION_STATUSES)} AS registration FROM raw""")
    add("norm_c10_clean_entities", BASE, "SELECT * EXCLUDE (other_names) FROM real")
    parts = ", ".join(blank(f"legal_address_{p}") for p in ("line1", "city", "postal"))
    add("norm_c11_text_profile", BASE, f"""SELECT lei, ingest_ord,
      coalesce({blank('legal_name')}, {blank('normalized_name')}, '(unnamed)')
      || ' | jurisdiction: ' || coalesce(jurisdiction, '-')
      || ' | country: ' || coalesce(country, '-') || ' | status: '
      || coalesce(entity_status, '-') || ' | address: '
      || coalesce(nullif(concat_ws(', ', {parts}), ''), '-')
      AS profile FROM real""")
    add("norm_c12_address_json", BASE, f"""SELECT ingest_ord, to_json({{'line1':
      legal_address_line1, 'city': legal_address_city, 'postal': legal_address_postal}})::VARCHAR
      AS legal_address, concat_ws(', ', {parts}) AS shown FROM real""")
    add("norm_c14_reason_codes", MATCHES, """SELECT id, to_json(codes)::VARCHAR AS codes,
      len(codes)::INT AS n_codes, array_to_string(codes, '|') AS joined FROM matches""")
    add("norm_c16_percent", MATCHES,
        "SELECT id, floor(final_score * 100 + 0.5)::BIGINT AS percent FROM matches")

    every = f"{ISO},\n{RAW},\n{cleaned('filings', 'raw', False)}"
    add("dq_g1_metrics", f"{every},\n{metrics('filings')}", "SELECT * FROM metrics")
    add("dq_g1_metrics_clean", f"{BASE},\n{metrics('real')}", "SELECT * FROM metrics")
    add("dq_d14_issues", f"{BASE},\n{ISSUES}", "SELECT lei, issue FROM issues")

    add("sink_b1_stage_roundtrip", BASE, """SELECT country, count(*) AS entities,
      count(legal_name) AS named, (SELECT count(*) FROM real) AS rows_written
      FROM real GROUP BY country""")
    add("sink_b3_vectors_roundtrip", VECTORS, """SELECT lei, len(embedding)::INT AS dims,
      round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 4) AS norm
      FROM vec""")
    merged = f"{BASE},\n{STORED},\n{upserted()}"
    add("sink_b4_upsert_entities", merged, "SELECT * FROM merged")
    add("sink_b4_upsert_small_load", merged, "SELECT * FROM merged")
    add("sink_b4_upsert_repeated_keys", f"{ISO}, {RAW}", f"""SELECT lei,
      arg_min(c, ingest_ord) AS country, arg_min(jurisdiction, ingest_ord) AS jurisdiction,
      arg_max(n, ingest_ord) AS legal_name, arg_max(l, ingest_ord) AS legal_address_line1,
      arg_max(s, ingest_ord) AS entity_status FROM (SELECT lei, ingest_ord,
        {country('country')} AS c, coalesce(jurisdiction, '') AS jurisdiction,
        trim(coalesce(legal_name, '')) AS n, {address('legal_address_line1')} AS l,
        {status('entity_status', R.ENTITY_STATUSES)} AS s FROM raw WHERE lei IS NOT NULL)
      GROUP BY lei""")
    add("sink_b5_new_matches", f"{MATCHES},\n{REVIEWS}", """SELECT id, lei_a, lei_b, final_score,
      decision FROM matches WHERE id NOT IN (SELECT id FROM reviews WHERE decision = 'accepted')""")
    add("sink_b6_quality_run", f"{BASE},\n{metrics('real')}", f"""SELECT {AS_OF} AS run_date,
      total_records, valid_records, invalid_records, missing_name_rate, missing_address_rate,
      duplicate_lei_count, data_quality_score FROM metrics""")
    add("sink_b8_graph_nodes", RAW, """SELECT 'Company' AS node_type, lei AS id,
      legal_name AS label FROM raw WHERE lei IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY lei ORDER BY ingest_ord DESC) = 1
      UNION ALL SELECT DISTINCT 'Country', country, country FROM raw
      WHERE lei IS NOT NULL AND country IS NOT NULL
      UNION ALL SELECT DISTINCT 'Jurisdiction', jurisdiction, jurisdiction FROM raw
      WHERE lei IS NOT NULL AND jurisdiction IS NOT NULL""")
    add("sink_b8_graph_edges", every, """SELECT DISTINCT lei AS src, country AS dst,
      'LOCATED_IN' AS edge_type, 'Company' AS src_type, 'Country' AS dst_type,
      NULL::DOUBLE AS final_score, NULL::VARCHAR AS decision FROM filings
      WHERE lei IS NOT NULL AND country IS NOT NULL UNION ALL
      SELECT DISTINCT lei, jurisdiction, 'REGISTERED_IN', 'Company', 'Jurisdiction', NULL, NULL
      FROM filings WHERE lei IS NOT NULL AND jurisdiction IS NOT NULL""")
    graph = f"{MATCHES},\n{GRAPH}"
    add("sink_b9_match_edges", graph,
        f"SELECT {EDGE_COLUMNS} FROM edges WHERE edge_type = 'MATCHED_TO'")
    add("sink_b10_ownership_edges", f"{BASE}, owned AS ({V.duck_view(V.RELATIONSHIPS)})",
        """SELECT DISTINCT lei AS src, parent_lei AS dst,
      'HAS_' || relationship_type || '_PARENT' AS edge_type, 'Company' AS src_type,
      'Company' AS dst_type, NULL::DOUBLE AS final_score, NULL::VARCHAR AS decision FROM owned
      WHERE relationship_type IN ('DIRECT', 'ULTIMATE') AND lei IN (SELECT lei FROM real)
      AND parent_lei IN (SELECT lei FROM real)""")
    space = "6ba7b8109dad11d180b400c04fd430c8"
    add("sink_b11_vector_index", f"{BASE},\n{VECTORS},\n{INDEX}", f"""SELECT
      h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
      || substr('89ab89ab89ab89ab', concat('0x', h[17])::INT + 1, 1) || h[18:20] || '-'
      || h[21:32] AS id, lei, CASE WHEN country = 'DE' THEN 'Renamed' ELSE legal_name END
      AS legal_name, normalized_name, country, jurisdiction, entity_status, round(norm, 4) AS norm
      FROM (SELECT *, sha1(unhex('{space}') || encode(lei)) AS h FROM points)""")

    add("er_j12_labelled_duplicates", f"{RAW},\n{noise()}",
        "SELECT ingest_ord, lei, origin_lei, legal_name, source FROM dup_raw")
    add("er_j12_sampled_duplicates", f"{RAW},\n{noise()}", """SELECT ingest_ord, lei, legal_name
      FROM dup_raw ORDER BY md5(coalesce(origin_lei, '') || ':' || ingest_ord || ':99')
      LIMIT 5000""")
    filings = f"{BASE},\n{NOISY},\n{FILING_PAIRS}"
    add("er_e1_pair_join", filings,
        "SELECT ingest_ord, lei_a, lei_b, na AS name_a, nb AS name_b FROM fp")
    add("er_e1_last_duplicate_wins", f"{BASE},\n{DUP}", """SELECT a.lei AS lei_a, b.lei AS lei_b,
      a.legal_name AS name_a FROM dup b JOIN (SELECT * FROM raw QUALIFY row_number() OVER
        (PARTITION BY lei ORDER BY ingest_ord DESC) = 1) a ON a.lei = replace(b.lei, 'SYNTH_', '')
      """)
    names = "txt AS (SELECT na AS a, nb AS b FROM fp)"
    add("er_j1_name_similarity", f"{filings},\n{names},\n{name_scores('txt')}",
        """SELECT ingest_ord, lei_b, coalesce(score, 0) AS name_similarity
      FROM fp LEFT JOIN name_scores ON a = na AND b = nb""")
    lines_ = "txt AS (SELECT aa AS a, ab AS b FROM fp)"
    add("er_j2_address_similarity", f"{filings},\n{lines_},\n{alignment('txt', ('set',))}",
        f"""SELECT ingest_ord, lei_b, aa AS addr_a, ab AS addr_b,
      coalesce({rounded('token_set', 4)}, 0) AS address_similarity
      FROM fp LEFT JOIN scores ON a = aa AND b = ab""")
    add("er_j6_vector_similarity", f"""{VECTORS},
      j AS (SELECT a.lei, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) /
        (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) *
         sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) + 1e-9) AS cos
        FROM vec a LEFT JOIN vec b ON b.lei = 'SYNTH_' || a.lei WHERE a.lei LIKE 'LEI%')""",
        f"""SELECT lei, greatest(0.0::DOUBLE, coalesce({rounded('cos', 4)}, 0))
      AS embedding_similarity FROM j""")
    add("er_j11_resolve", MATCHES, f"SELECT {MATCH_COLUMNS} FROM matches")
    add("er_j11_resolve_filings", f"{filings},\n{scored('fp', vector=False)}",
        """SELECT decision, count(*) AS pairs, min(final_score) AS lowest,
      max(final_score) AS highest FROM matches GROUP BY decision""")
    plain = f"""pairs AS (SELECT {pair_columns()} FROM dup b
      JOIN real a ON a.lei = replace(b.lei, 'SYNTH_', ''))"""
    add("er_s1_renormalised",
        f"{BASE},\n{DUP},\n{plain},\n{scored('pairs', vector=False, spread=True)}",
        "SELECT id, final_score, decision FROM matches")
    asked = f"""asked AS ({V.duck_view(V.RELATIONSHIPS)}),
      pairs AS (SELECT {pair_columns()} FROM asked JOIN ent a ON a.lei = asked.lei
        JOIN ent b ON b.lei = asked.parent_lei)"""
    ent = """ent AS (SELECT * REPLACE (coalesce(legal_name, '') AS legal_name,
      coalesce(normalized_name, '') AS normalized_name) FROM real WHERE lei IS NOT NULL)"""
    add("er_e3_compare", f"{BASE},\n{ent},\n{asked},\n{scored('pairs', vector=False)}",
        f"SELECT {MATCH_COLUMNS.replace(', created_at', '')} FROM matches")
    add("er_e3_unknown_keys", f"{BASE}, asked AS ({V.duck_view(V.RELATIONSHIPS)})",
        """SELECT lei FROM (SELECT lei FROM asked UNION SELECT parent_lei FROM asked)
      WHERE lei NOT IN (SELECT lei FROM real WHERE lei IS NOT NULL)""")

    store = f"{BASE},\n{STORED}"
    add("search_h1_page", store, f"""SELECT {STORED_COLUMNS} FROM stored
      WHERE (normalized_name ILIKE '%north h%r%' OR lei ILIKE '%north h%r%'
        OR legal_name ILIKE '%north h%r%') AND jurisdiction ILIKE '%nation_%'
        AND entity_status = 'ACTIVE' ORDER BY legal_name, lei LIMIT 50 OFFSET 3""")
    add("search_d3_country", store, f"""SELECT {STORED_COLUMNS} FROM stored WHERE country = 'DE'
      ORDER BY legal_name, lei LIMIT 100""")
    add("search_d6_lookup", store, f"SELECT * FROM stored WHERE lei = '{PROBE_KEY}'")
    add("search_h2_match_page", MATCHES, f"""SELECT {MATCH_COLUMNS} FROM matches
      WHERE decision = '{R.REVIEW}' ORDER BY final_score DESC, id LIMIT 200 OFFSET 5""")
    add("search_h3_duplicates", MATCHES, f"""SELECT {MATCH_COLUMNS} FROM matches
      WHERE (lei_a = '{PROBE_KEY}' OR lei_b = '{PROBE_KEY}')
      AND decision IN ({quoted(R.LINKED_DECISIONS)}) ORDER BY final_score DESC, id LIMIT 20""")
    add("search_h3_duplicates_batch", f"{MATCHES},\n{LISTED}",
        "SELECT lei, rank, id, final_score FROM listed")
    add("search_h4_latest_run", RUNS, "SELECT * FROM runs ORDER BY run_date DESC LIMIT 1")
    add("search_g4_dashboard", f"{MATCHES},\n{STORED},\n{INDEX},\n{RUNS}", f"""SELECT
      (SELECT count(*) FROM stored) AS total_entities,
      (SELECT count(*) FROM stored WHERE entity_status = 'ACTIVE') AS active_entities,
      (SELECT count(*) FROM matches WHERE decision = '{R.SAME}') AS duplicate_matches,
      (SELECT count(*) FROM matches WHERE decision = '{R.REVIEW}') AS needs_review,
      (SELECT arg_max(data_quality_score, run_date) FROM runs) AS data_quality_score,
      (SELECT strftime(max(run_date), '%Y-%m-%d %H:%M:%S') FROM runs) AS last_pipeline_run,
      (SELECT count(*) FROM points) AS vector_index_size""")
    indexed = f"{BASE},\n{VECTORS},\n{INDEX}"
    add("search_g5_vector_count", indexed, "SELECT count(*) AS vector_count FROM points")

    add("vec_k1_embed_quality", BASE, """SELECT count(*) AS vectors, count(DISTINCT lei) AS keys,
      256 AS dims, 1.0::DOUBLE AS shortest, 1.0::DOUBLE AS longest FROM real
      WHERE lei IS NOT NULL""")
    mean = """m AS (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos
      FROM embeddings), q AS (SELECT 0 AS query_id, list(v ORDER BY pos) AS qv FROM
      (SELECT pos, avg(v) AS v FROM m GROUP BY pos))"""
    add("vec_k2_topk", f"{indexed},\n{mean},\n{top_k(10, 'q', chr(39).join(['entity_status = ', 'ACTIVE', '']))}",
        """SELECT lei, legal_name, normalized_name, country, jurisdiction, entity_status, score
      FROM found""")
    own = "q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings)"
    for key in ("vec_k2_topk_batch", "vec_k2_topk_grid"):
        add(key, f"{indexed},\n{own},\n{top_k(5, 'q')}",
            "SELECT query_id, rank, lei, score FROM found")
    add("vec_k3_parsed_filters", f"""{indexed},\n{CENTROIDS},
      q AS (SELECT *, CASE WHEN query_id % 2 = 0 THEN 'DE' ELSE 'FR' END AS c,
        CASE WHEN query_id % 3 = 0 THEN 'ACTIVE' END AS s FROM centroids),
      {top_k(3, 'q', 'country = c AND (s IS NULL OR entity_status = s)')}""",
        "SELECT query_id, rank, lei, legal_name, country, entity_status, score FROM found")

    add("graph_l1_nodes", f"{graph},\n{AROUND}", "SELECT key, id, label, type FROM hood1")
    add("graph_l1_edges", f"{graph},\n{AROUND}", """SELECT key,
      CASE direction WHEN 'out' THEN key ELSE other END AS source,
      CASE direction WHEN 'out' THEN other ELSE key END AS target, edge_type FROM inc""")
    add("graph_l1_one_entity", f"{graph},\n{AROUND}",
        f"SELECT key, id, label, type FROM hood1 WHERE key = '{PROBE_KEY}'")
    add("graph_l2_relationships", f"{graph},\n{LINKS}", "SELECT * FROM links")

    seen = f"{MATCHES},\n{REVIEWS}"
    add("review_n1_with_reviews", seen, """SELECT id, decision, reviewer_decision, reviewed_at
      FROM matches LEFT JOIN latest USING (id)""")
    add("review_n1_unknown", seen, """SELECT id, reviewer_decision FROM latest
      WHERE id NOT IN (SELECT id FROM matches)""")
    add("review_n2_queue", seen, f"""SELECT id, final_score, reviewer_decision, reviewed_at
      FROM (SELECT * FROM matches WHERE decision = '{R.REVIEW}'
        ORDER BY final_score DESC, id LIMIT 200) LEFT JOIN latest USING (id)""")
    add("review_g10_counts", seen, """SELECT count(reviewer_decision) AS reviewed,
      count(*) - count(reviewer_decision) AS pending FROM matches LEFT JOIN latest USING (id)""")

    yes = "CASE WHEN {} >= 1.0::DOUBLE THEN 'Yes' ELSE 'No' END"
    add("report_m1_explanations", MATCHES, f"""SELECT id, coalesce(name_a, '') || ' and '
      || coalesce(name_b, '') || ': ' || decision || ' at ' || {two('final_score')} || ' (name '
      || {two('name_similarity')} || ', address ' || {two('address_similarity')} || ', vector '
      || {two('embedding_similarity')} || '; same country: ' || {yes.format('country_match')}
      || ', same jurisdiction: ' || {yes.format('jurisdiction_match')} || '; reasons: '
      || coalesce(nullif(array_to_string(codes, ', '), ''), 'none') || ')' AS explanation
      FROM matches""")
    section = """coalesce((SELECT string_agg('- ' || line, chr(10) ORDER BY {order})
      FROM {source} WHERE {key} = s.lei), 'None identified')"""
    dups = section.format(order="rank", source=f"""(SELECT lei, rank, coalesce(name_b, lei_b, '')
      || ' (score: ' || {two('final_score')} || ')' AS line FROM listed)""", key="lei")
    rels = section.format(
        order="rel_type || ':' || target_label || ':' || target_lei",
        source="(SELECT *, rel_type || ' → ' || target_label AS line FROM links)", key="key")
    qual = section.format(order="line", source="(SELECT lei, issue AS line FROM issues)",
                          key="lei")
    address_parts = ", ".join(
        f"nullif(trim(legal_address::JSON->>'$.{p}'), '')" for p in ("line1", "city", "postal"))
    add("report_m2_verification", f"{graph},\n{LINKS},\n{STORED},\n{ISSUES},\n{LISTED}",
        f"""SELECT lei, 0 AS page, legal_name || ' [' || lei || ']' || chr(10) || 'country '
      || coalesce(country, '') || ', jurisdiction ' || coalesce(jurisdiction, '') || chr(10)
      || 'status ' || coalesce(entity_status, '') || ', registration '
      || coalesce(registration_status, '') || chr(10) || 'address '
      || concat_ws(', ', {address_parts}) || chr(10) || 'managed by '
      || coalesce(managing_lou, '') || chr(10) || chr(10)
      || 'Duplicate candidates' || chr(10) || {dups} || chr(10) || chr(10)
      || 'Links to other records' || chr(10) || {rels} || chr(10) || chr(10)
      || 'Data quality' || chr(10) || {qual} || chr(10) || chr(10)
      || 'Watchlist hits' || chr(10) || 'None identified' AS report_text FROM stored s""")
    add("report_b12_append", store, """SELECT 2 * count(*) AS rows, count(*) AS ids,
      count(DISTINCT lei) AS entities FROM stored""")
    words = "' ' || trim(regexp_replace(upper(text), '[^A-Z_]+', ' ', 'g')) || ' '"
    said = " ".join(
        f"WHEN contains({words}, ' {c.replace('_', ' ')} ') OR contains({words}, ' {c} ') "
        f"THEN '{c}'" for c in R.ENTITY_STATUSES
    )
    place = r"(?i)\b(?:jurisdiction of|registered in)\s+([\p{L}0-9_]+(?: [\p{Lu}][\p{L}0-9_]*)*)"
    add("report_m3_parsed_queries", f"{ISO}, asked AS ({V.duck_view(V.SEARCH_TEXT)})",
        f"""SELECT query_id, text AS semantic_query, (SELECT arg_max(code, length(said)) FROM iso
      WHERE length(said) > 3 AND contains({words}, ' ' || said || ' ')) AS parsed_country,
      CASE {said} END AS parsed_entity_status,
      nullif(regexp_extract(text, '{place}', 1), '') AS parsed_jurisdiction FROM asked""")
    return o


def all_oracles() -> dict[str, str]:
    from checks.linkage import linkage_oracles
    from checks.nearby import nearby_oracles

    return base_oracles() | linkage_oracles() | nearby_oracles()
