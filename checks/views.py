"""Company data derived from the driver tables, as SQL that Spark and DuckDB both run.

Every order is one registry filing of its customer, so a key repeats as often as the
customer orders; every row of the source tables takes part. ``{name}`` stands for a
driver table.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

NATION_CODES = "US,GB,DE,FR,JP,CA,CH,NL,SE,IE,IT,ES,BR,IN,AU,SG,ZA,MX,NO,FI,DK,PL,AT,BE,NA"
NATION_CODES3 = (
    "USA,GBR,DEU,FRA,JPN,CAN,CHE,NLD,SWE,IRL,ITA,ESP,BRA,IND,AUS,SGP,ZAF,MEX,NOR,FIN,DNK,POL,"
    "AUT,BEL,NAM"
)
NATION_NAMES = (
    "United States,United Kingdom,Germany,France,Japan,Canada,Switzerland,Netherlands,Sweden,"
    "Ireland,Italy,Spain,Brazil,India,Australia,Singapore,South Africa,Mexico,Norway,Finland,"
    "Denmark,Poland,Austria,Belgium,Namibia"
)


def pick(words: str, number: str) -> str:
    """Word number ``number`` (0-based, wraps) of a comma-separated list."""
    return f"split_part('{words}', ',', cast(({number}) % {words.count(',') + 1} + 1 AS int))"


def pick_any(words: str, number: str) -> str:
    """The same for a '|'-separated list."""
    return f"split_part('{words}', '|', cast(({number}) % {words.count('|') + 1} + 1 AS int))"


COMPANY_NAME = (
    pick("Apex,Boréalis,Cobalt,Dunmore,Eastgate,Müller,Granite,North Harbor,Ironwood,Juniper", "k")
    + " || ' ' || "
    + pick("Capital,Logistics,Foods,Mining,Software,Textiles,Energía", "k")
    + " || ' ' || cast(cast(floor(k / 70) AS bigint) AS string) || ' ' || "
    + pick_any("Inc.|Incorporated|Corporation|Limited|L.L.C.|N.A.|Gmbh|Company|Plc|Corp.|Ltd.|"
               "LLC|Co.|S.A. Holding|B.V.|Road Works, Inc.", "k")
)
STREETS = "North Market Street,Harbor Road,East Lake Drive,Queens Boulevard,South Mill Avenue"
CITIES = "New York,Frankfurt,Toronto,Lyon,Osaka"
STATUSES = "ACTIVE|active|Inactive|pending transfer|Pending-Archival|BANANA|MERGED"
REGISTRATIONS = "ISSUED|lapsed|Pending Validation|NOPE"

RAW = f"""
SELECT r AS ingest_ord,
  CASE WHEN r % 211 = 13 THEN NULL ELSE lei END AS lei,
  CASE WHEN r % 97 = 5 THEN NULL WHEN r % 89 = 7 THEN '  '
       WHEN r % 4 = 0 THEN upper(nm) WHEN r % 4 = 1 THEN lower(nm) ELSE nm END AS legal_name,
  CASE WHEN r % 6 = 0 THEN NULL ELSE '["' || nm || ' Group"]' END AS other_names,
  CASE WHEN r % 11 = 3 THEN NULL
       ELSE cast(k % 900 + 1 AS string) || ' ' || {pick(STREETS, "r")}
            || CASE WHEN r % 3 = 0 THEN '  suite 4' ELSE '' END END AS legal_address_line1,
  {pick(CITIES, "k")} AS legal_address_city,
  CASE WHEN r % 23 = 0 THEN NULL WHEN r % 19 = 0 THEN 'XX' WHEN r % 17 = 0 THEN country_name
       WHEN r % 13 = 0 THEN alpha3 WHEN r % 5 = 1 THEN lower(cc) ELSE cc END AS country,
  CASE WHEN r % 8 = 2 THEN NULL ELSE lpad(cast(k % 99999 AS string), 5, '0') END
    AS legal_address_postal,
  CASE WHEN r % 9 = 4 THEN '' ELSE cast(k % 50 + 1 AS string) || ' West Dock Street floor 2' END
    AS hq_address_line1,
  {pick(CITIES, "k + 2")} AS hq_address_city,
  lower(country_name) AS hq_country,
  CASE WHEN r % 29 = 0 THEN '' ELSE n_name END AS jurisdiction,
  {pick_any(STATUSES, "r")} AS entity_status,
  cast(o_orderdate AS string) AS initial_registration_date,
  cast(o_orderdate AS string) AS last_update_date,
  {pick_any(REGISTRATIONS, "r")} AS registration_status,
  'LOU' || cast(n_regionkey AS string) AS managing_lou
FROM (
  SELECT o_orderkey AS r, c_custkey AS k, o_orderdate, n_name, n_regionkey,
    'LEI' || lpad(cast(c_custkey AS string), 17, '0') AS lei,
    {pick(NATION_CODES, "n_nationkey")} AS cc,
    {pick(NATION_CODES3, "n_nationkey")} AS alpha3,
    {pick(NATION_NAMES, "n_nationkey")} AS country_name,
    {COMPANY_NAME.replace("k %", "c_custkey %").replace("(k /", "(c_custkey /")} AS nm
  FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
    JOIN {{nation}} ON c_nationkey = n_nationkey
) t
"""

# Suppliers file as companies of their own: new keys for the upsert queries.
SUPPLIER_RAW = f"""
SELECT s_suppkey AS ingest_ord, 'SUP' || lpad(cast(s_suppkey AS string), 17, '0') AS lei,
  s_name || ' Company' AS legal_name,
  cast(s_suppkey % 300 + 1 AS string) || ' Dock Road' AS legal_address_line1,
  {pick(CITIES, "s_suppkey")} AS legal_address_city,
  {pick(NATION_CODES, "n_nationkey")} AS country, n_name AS jurisdiction,
  {pick_any(STATUSES, "s_suppkey")} AS entity_status, 'ISSUED' AS registration_status
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

# Real keys carry their own vector, marked keys the next one.
VECTORS = """
SELECT 'LEI' || lpad(cast(vec_id AS string), 17, '0') AS lei, embedding FROM {embeddings}
UNION ALL
SELECT 'SYNTH_LEI' || lpad(cast(a.vec_id AS string), 17, '0') AS lei, b.embedding
FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1
"""

# One JSON line per supplier, plus a broken and a blank line for each.
WATCHLIST_LINES = f"""
SELECT '{{{{"id":"OS-' || cast(s_suppkey AS string) || '","schema":"'
  || {pick_any("Company|Organization|LegalEntity|Person|Vessel", "s_suppkey")}
  || '","datasets":["ofac","' || lower(n_name) || '"],"properties":{{{{'
  || CASE WHEN s_suppkey % 7 = 3 THEN '' ELSE '"name":["' || s_name || '","alias"],' END
  || '"country":[' || CASE WHEN s_suppkey % 5 = 2 THEN '' ELSE
       '"' || lower({pick(NATION_CODES, "n_nationkey")}) || '"' END || ']}}}}}}}}' AS value
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
UNION ALL SELECT '{{{{"id":"OS-' || cast(s_suppkey AS string) || '", broken' AS value
FROM {{supplier}}
UNION ALL SELECT '   ' AS value FROM {{supplier}}
"""

RELATIONSHIPS = """
SELECT 'LEI' || lpad(cast(c_custkey AS string), 17, '0') AS lei,
  'LEI' || lpad(cast(cast(floor(c_custkey / 10) AS bigint) AS string), 17, '0') AS parent_lei,
  CASE WHEN c_custkey % 3 = 0 THEN 'ULTIMATE' WHEN c_custkey % 2 = 0 THEN 'DIRECT'
       ELSE 'OTHER' END AS relationship_type
FROM {customer}
UNION ALL
SELECT 'LEI' || lpad(cast(c_custkey AS string), 17, '0') AS lei,
  'GONE' || cast(c_nationkey AS string) AS parent_lei, 'DIRECT' AS relationship_type
FROM {customer}
"""

# Reviewer events: purchases and sign-ups accept, errors reject, the rest say nothing.
# Chains over thirds, second parents, pairs of companies that own each other, and rows to drop.
OWNERSHIP = """
SELECT 'LEI' || lpad(cast(k AS string), 17, '0') AS lei,
  'LEI' || lpad(cast(p AS string), 17, '0') AS parent_lei, kind AS relationship_type
FROM (
  SELECT c_custkey AS k, cast(floor(c_custkey / 3) AS bigint) AS p, 'DIRECT' AS kind
  FROM {customer} WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey AS k, c_custkey - 5 AS p, 'DIRECT' AS kind FROM {customer} WHERE c_custkey % 7 = 0
  UNION ALL SELECT c_custkey AS k, c_custkey + 1 AS p, 'DIRECT' AS kind FROM {customer} WHERE c_custkey % 101 = 1
  UNION ALL SELECT c_custkey AS k, c_custkey - 1 AS p, 'DIRECT' AS kind FROM {customer} WHERE c_custkey % 101 = 2
  UNION ALL SELECT c_custkey AS k, cast(NULL AS bigint) AS p, 'DIRECT' AS kind FROM {customer}
  UNION ALL SELECT c_custkey AS k, c_custkey + 2 AS p, 'OTHER' AS kind FROM {customer}
) t
"""

# Pairs a reviewer confirmed: runs of six companies that follow each other.
CONFIRMED = """
SELECT 'LEI' || lpad(cast(c_custkey AS string), 17, '0') AS lei_a,
  'LEI' || lpad(cast(c_custkey + 1 AS string), 17, '0') AS lei_b
FROM {customer} WHERE c_custkey % 6 <> 0
"""

# Watchlist lines with names like those of companies, and a second name each.
SCREEN_LINES = f"""
SELECT '{{{{"id":"OS-' || cast(s_suppkey AS string) || '","schema":"'
  || {pick_any("Company|Organization|LegalEntity|Person", "s_suppkey")}
  || '","datasets":["ofac","' || lower(n_name) || '"],"properties":{{{{"name":['
  || CASE WHEN s_suppkey % 9 = 4 THEN '' ELSE '"' || upper(nm) || '","Trading ' || nm || ' Overseas"' END
  || '],"country":[' || CASE WHEN s_suppkey % 5 = 2 THEN '' ELSE
       '"' || lower({pick(NATION_CODES, "n_nationkey")}) || '"' END || ']}}}}}}}}' AS value
FROM (SELECT s_suppkey, s_nationkey, s_suppkey AS k, {COMPANY_NAME} AS nm FROM {{supplier}}) s JOIN {{nation}} ON s_nationkey = n_nationkey
UNION ALL SELECT '{{{{"id":"OS-' || cast(s_suppkey AS string) || '", broken' AS value FROM {{supplier}}
"""

REVIEW_EVENTS = """
SELECT CASE WHEN event_type = 'signup' AND value > 20 THEN 'GONE' ELSE 'LEI' END
    || lpad(cast(user_id AS string), 17, '0') AS lei,
  CASE WHEN event_type = 'error' THEN 'rejected' WHEN event_type IN ('purchase', 'signup')
       THEN 'accepted' ELSE 'looked' END AS decision,
  ts, event_id AS seq
FROM {events}
"""

QUALITY_RUNS = """
SELECT cast(date_trunc('day', ts) AS timestamp) AS run_date, count(*) AS total_records,
  count(CASE WHEN value > 5 THEN 1 END) AS valid_records
FROM {events} GROUP BY 1
"""

SEARCH_TEXT = f"""
SELECT s_suppkey AS query_id,
  {pick_any("active|Inactive|MERGED|all|pending transfer", "s_suppkey")} || ' '
  || {pick("Mining,Foods,Software,Energy", "s_suppkey")} || ' companies '
  || CASE WHEN s_suppkey % 3 = 0 THEN 'registered in ' || n_name ELSE
     'in ' || {pick(NATION_NAMES, "n_nationkey")} END AS text
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

TABLES = ("orders", "customer", "nation", "supplier", "embeddings", "events", "documents")


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_view(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """The view over the driver tables; ``given`` replaces a table by one with the same rows."""
    used = {t: given[t] if t in given else table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def duck_view(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})
