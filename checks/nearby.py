"""Queries of approximate search, ranked countries, split extracts and stored tables, with their SQL."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from checks import oracles as O
from checks import queries as Q
from checks import views as V
from orgkin import refdata as R
from orgkin.operators import countries, neighbours, quality, search, vectors
from orgkin.operators.clean import stage_boundary
from orgkin.session import scratch_dir
from orgkin.sources import registry, tables

SHAPE = neighbours.HashTables(64, floor=500)  # a lower floor, so that filters of small tables walk too


# --- approximate neighbours -------------------------------------------------------------------
def _asked(spark, sf):
    """Every twentieth vector: a third anywhere, a third in one country, a third active there."""
    turn = F.col("vec_id") % 60
    return V.table(spark, sf, "embeddings").filter("vec_id % 20 = 0").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"),
        F.when(turn == 20, "us").when(turn == 40, "de").alias("country"),
        F.when(turn == 40, "ACTIVE").alias("entity_status"),
    )


def _tables(spark, sf):
    return Q.staged(spark, sf, "hash-tables", lambda *_: neighbours.hash_rows(Q.index(spark, sf), SHAPE))


def _near(spark, sf):
    return neighbours.near(Q.index(spark, sf), _tables(spark, sf), _asked(spark, sf), SHAPE, 10)


def vec_x8_near(spark, sf):
    found = _near(spark, sf)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "lei", "country", "entity_status", "score")


def vec_x8_recall(spark, sf):
    """Per filter: exact results, how many were found, and rows scored for them."""
    kind = (F.col("query_id") % 60).alias("filter")
    exact = vectors.search_batch(Q.index(spark, sf), _asked(spark, sf), 10)
    hits = neighbours.recall(_near(spark, sf), exact).groupBy(kind).agg(
        F.sum("wanted").alias("wanted"), F.sum("found").alias("found")
    )
    met = neighbours.candidates(_tables(spark, sf), vectors.asked_queries(_asked(spark, sf)), SHAPE)
    return hits.join(met.groupBy(kind).agg(F.count(F.lit(1)).alias("candidates")), "filter")


NEAR = f"""planes AS (SELECT t, b, list(CASE WHEN substr(md5(t || ':' || b || ':' || d), 1, 1) < '8' THEN 1.0 ELSE -1.0 END ORDER BY d)::DOUBLE[] AS w
  FROM range({SHAPE.tables}) x(t), range({SHAPE.bits}) y(b), range({SHAPE.dimensions}) z(d) GROUP BY t, b),
kept AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY e, country, entity_status ORDER BY lei) <= {SHAPE.same}),
hashed AS (SELECT lei, country, entity_status, t, sum(CASE WHEN list_inner_product(e, w) > 0 THEN 1 << b ELSE 0 END)::BIGINT AS bucket
  FROM kept, planes GROUP BY ALL),
q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv, CASE vec_id % 60 WHEN 20 THEN 'US' WHEN 40 THEN 'DE' END AS c,
  CASE WHEN vec_id % 60 = 40 THEN 'ACTIVE' END AS s FROM embeddings WHERE vec_id % 20 = 0),
away AS (SELECT query_id, c, s, t, list(list_inner_product(qv, w) / sqrt(list_inner_product(qv, qv)) ORDER BY b) AS a FROM q, planes GROUP BY ALL),
reach AS (SELECT query_id, c, s, t, round(list_sum(list_transform(range({SHAPE.bits}), lambda b: abs(a[b + 1]) * ((m >> b) & 1))), 9) AS cost,
  xor(list_sum(list_transform(range({SHAPE.bits}), lambda b: CASE WHEN a[b + 1] > 0 THEN 1 << b ELSE 0 END))::BIGINT, m) AS bucket
  FROM away, range({1 << SHAPE.bits}) y(m)),
sized AS (SELECT query_id, t, bucket, cost, count(*) AS n FROM reach JOIN hashed h USING (t, bucket)
  WHERE (c IS NULL OR h.country = c) AND (s IS NULL OR h.entity_status = s) GROUP BY ALL),
passing AS (SELECT query_id, sum(n) FILTER (t = 0) AS passing FROM sized GROUP BY 1),
walked AS (SELECT query_id, t, bucket, passing, coalesce(sum(n) OVER (PARTITION BY query_id ORDER BY cost, t, bucket
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM sized JOIN passing USING (query_id)),
met AS (SELECT query_id, h.lei FROM walked w JOIN hashed h USING (t, bucket) JOIN q USING (query_id)
  WHERE seen < greatest({SHAPE.floor}, {SHAPE.reads} * passing) AND (c IS NULL OR h.country = c) AND (s IS NULL OR h.entity_status = s)
  GROUP BY ALL HAVING count(*) >= {SHAPE.agree}),
scored_for AS (SELECT query_id, lei FROM met QUALIFY count(*) OVER (PARTITION BY query_id) >= 10
  UNION ALL SELECT query_id, lei FROM q JOIN points ON (c IS NULL OR country = c) AND (s IS NULL OR entity_status = s)
  WHERE query_id NOT IN (SELECT query_id FROM met GROUP BY 1 HAVING count(*) >= 10)),
{O.top_k(10, 'q', '(q.query_id, p.lei) IN (SELECT (query_id, lei) FROM scored_for)')}"""
EXACT = """every AS (SELECT query_id, lei FROM (SELECT q.query_id, p.lei, list_inner_product(p.e, q.qv) /
    (sqrt(list_inner_product(q.qv, q.qv)) * p.norm + 1e-9) AS cos FROM points p JOIN q
    ON (c IS NULL OR country = c) AND (s IS NULL OR entity_status = s))
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 6) DESC, lei) <= 10)"""


# --- ranked countries ---------------------------------------------------------------------------
# A letter of each customer's nation name is left out; the place goes round the name.
MISSPELT = f"""
SELECT c_custkey, c_said, substr(c_said, 1, gap - 1) || substr(c_said, gap + 1) AS text
FROM (SELECT *, cast(c_custkey % (length(c_said) - 1) + 1 AS int) AS gap
  FROM (SELECT c_custkey, {V.pick(V.NATION_NAMES, "c_nationkey")} AS c_said FROM {{customer}}))
"""


def _nation_names(spark):
    rows = list(zip(V.NATION_CODES.split(","), V.NATION_NAMES.split(","), strict=True))
    return spark.createDataFrame(rows, "code string, name string")


def norm_c8_ranked(spark, sf):
    found = countries.ranked_countries(V.spark_view(spark, sf, MISSPELT), "text", 3, _nation_names(spark))
    return found.select("text", F.col("rank").cast("long").alias("rank"), "code", F.round("score", 9).alias("score"))


TRIPLES = "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr('  ' || {0} || ' ', i, 3)))"
RANKED = f"""codes AS (SELECT unnest(string_split('{V.NATION_CODES}', ',')) AS code, unnest(string_split('{V.NATION_NAMES.upper()}', ',')) AS name),
asked AS (SELECT DISTINCT text, trim(upper(text)) AS said FROM ({V.duck_view(MISSPELT)})),
shared AS (SELECT text, code, len(list_intersect(a, b)) AS n, len(a) + len(b) AS total FROM
  (SELECT text, code, {TRIPLES.format('said')} AS a, {TRIPLES.format('name')} AS b FROM asked, codes))"""


# --- split extracts -------------------------------------------------------------------------------
def src_a1_split_csv(spark, sf):
    """Plain extracts whose addresses hold line breaks and quotes, read by byte ranges."""
    path = scratch_dir(spark, "registry")
    names = {t: s for s, t in R.REGISTRY_COLUMNS.items()}
    broken = F.regexp_replace("legal_address_line1", " ", '\n"')
    rows = Q.raw(spark, sf).withColumn("legal_address_line1", broken)
    rows.select(*[F.col(c).alias(names[c]) for c in names]).write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return stage_boundary(registry.read_registry(spark, path, split=True)).select(
        "lei", "legal_name", "country", "jurisdiction", "legal_address_line1", "managing_lou")


# --- reports and stored tables ----------------------------------------------------------------------
def _metrics(spark, sf):
    return quality.quality_metrics(Q.clean(spark, sf), Q.AS_OF)


def sink_b2_latest_report(spark, sf):
    """Two reports in one folder and the run rows: the newest report is shown."""
    path = scratch_dir(spark, "quality-report")
    now = _metrics(spark, sf)
    earlier = now.withColumn("run_date", F.col("run_date") - F.expr("INTERVAL 1 DAY")).withColumn("valid_records", F.lit(0))
    tables.write_quality_report(now, path, "today")
    tables.write_quality_report(earlier, path, "yesterday")
    shown = search.latest_quality(tables.read_quality_reports(spark, path), Q.runs(spark, sf))
    return shown.select("total_records", "valid_records", "duplicate_lei_count", "data_quality_score")


def dq_c19_elapsed(spark, sf):
    """The run time is that of the work: positive, and no longer than the query took."""
    started = time.time()
    done = quality.timed(_metrics(spark, sf), started)
    seconds = F.col("pipeline_runtime_seconds")
    return done.select("total_records", ((seconds > 0) & (seconds <= time.time() - started + 0.01)).alias("timed"))


def sink_b7_stored_tables(spark, sf):
    """Tables made twice, matches appended to theirs and read back."""
    prefix = f"run_{uuid.uuid4().hex}_"
    made = tables.ensure_tables(spark, prefix) and tables.ensure_tables(spark, prefix)
    table = next(t for t in made if "match" in t)
    tables.append_table(Q.matches(spark, sf), table)
    return tables.read_table(spark, table).select("id", "lei_a", "lei_b", "final_score", "decision")


def nearby_queries():
    return {n: f for n, f in globals().items() if n.startswith(Q.PREFIXES) and callable(f)}


def nearby_oracles() -> dict[str, str]:
    near = f"WITH {O.BASE},\n{O.VECTORS},\n{O.INDEX},\n{NEAR}"
    clean = O.blank
    return {
        "src_a1_split_csv": f"""WITH {O.RAW} SELECT {clean('lei')} AS lei, {clean('legal_name')} AS legal_name, {clean('country')} AS country,
  {clean('jurisdiction')} AS jurisdiction, {clean("replace(legal_address_line1, ' ', chr(10) || chr(34))")} AS legal_address_line1,
  managing_lou FROM raw""",
        "sink_b2_latest_report": f"""WITH {O.BASE},\n{O.metrics('real')} SELECT total_records, valid_records,
  duplicate_lei_count, data_quality_score FROM metrics""",
        "dq_c19_elapsed": f"WITH {O.BASE} SELECT count(*) AS total_records, true AS timed FROM real",
        "sink_b7_stored_tables": f"WITH {O.MATCHES} SELECT id, lei_a, lei_b, final_score, decision FROM matches",
        "vec_x8_near": f"{near} SELECT query_id, rank, lei, country, entity_status, score FROM found",
        "vec_x8_recall": f"""{near},\n{EXACT} SELECT e.query_id % 60 AS filter, count(*) AS wanted, count(f.lei) AS found,
  any_value(m.n) AS candidates FROM every e LEFT JOIN found f ON f.query_id = e.query_id AND f.lei = e.lei
  JOIN (SELECT query_id % 60 AS filter, count(*) AS n FROM met GROUP BY 1) m ON m.filter = e.query_id % 60 GROUP BY 1""",
        "norm_c8_ranked": f"""WITH {RANKED} SELECT text, row_number() OVER (PARTITION BY text ORDER BY 2.0 * n / total DESC, code) AS rank,
  code, round(2.0::DOUBLE * n / total, 9) AS score FROM shared WHERE n > 0 QUALIFY rank <= 3""",
    }
