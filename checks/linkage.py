"""Queries of ownership chains, merged records, blocking and screening, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracles as O
from checks import queries as Q
from checks import views as V
from orgkin import refdata as R
from orgkin.operators import (
    addresses, benchmark, blocking, merge, merged, ownership, resolve, screening, search, snapshots,
)
from orgkin.session import scratch_dir
from orgkin.sources import watchlist


# --- ownership chains ---------------------------------------------------------------------
def _parents(spark, sf):
    return ownership.ultimate_parents(V.spark_view(spark, sf, V.OWNERSHIP))


def graph_x2_ultimate_parents(spark, sf):
    return _parents(spark, sf).withColumn("path", F.array_join("path", ">"))


def graph_x2_control_groups(spark, sf):
    return ownership.control_groups(_parents(spark, sf))


CHAINS = f"""steps AS (SELECT DISTINCT lei, parent_lei FROM ({V.duck_view(V.OWNERSHIP)})
  WHERE relationship_type = 'DIRECT' AND parent_lei IS NOT NULL),
walk AS (
  SELECT lei, parent_lei AS place, 1 AS depth, [lei, parent_lei] AS path, lei = parent_lei AS back FROM steps
  UNION ALL SELECT w.lei, s.parent_lei, depth + 1, list_append(path, s.parent_lei),
    list_contains(path, s.parent_lei) FROM walk w JOIN steps s ON s.lei = w.place WHERE NOT back),
tops AS (SELECT lei, place, depth, path FROM walk
  WHERE NOT back AND place NOT IN (SELECT lei FROM steps)
  QUALIFY row_number() OVER (PARTITION BY lei, place ORDER BY depth, path) = 1),
looped AS (SELECT DISTINCT lei FROM walk WHERE back),
parents AS (
  SELECT lei, place AS ultimate_parent, depth, array_to_string(path, '>') AS path, lei IN (SELECT lei FROM looped) AS in_cycle
  FROM tops
  UNION ALL SELECT DISTINCT lei, NULL, NULL, NULL, true FROM steps WHERE lei NOT IN (SELECT lei FROM tops))"""


# --- merged records -----------------------------------------------------------------------
def _records(spark, sf):
    fields = ["lei", "last_update_date", *merged.FIELDS]
    return Q.clean(spark, sf).select(*fields).unionByName(Q.duplicates(spark, sf).select(*fields))


def _members(spark, sf):
    linked = Q.matches(spark, sf).filter(F.col("decision").isin(*R.LINKED_DECISIONS)).select("lei_a", "lei_b")
    return merged.clusters(linked.unionByName(V.spark_view(spark, sf, V.CONFIRMED)))


def er_x3_clusters(spark, sf):
    return _members(spark, sf)


def er_x3_merged_records(spark, sf):
    return merged.merged_records(_records(spark, sf), _members(spark, sf))


CLUSTERS = f"""linked AS (SELECT lei_a, lei_b FROM matches WHERE decision IN ({O.quoted(R.LINKED_DECISIONS)})
  UNION {V.duck_view(V.CONFIRMED)}),
sides AS (SELECT lei_a AS u, lei_b AS v FROM linked WHERE lei_a <> lei_b UNION SELECT lei_b, lei_a FROM linked WHERE lei_a <> lei_b),
reach AS (SELECT u, v FROM sides UNION SELECT r.u, b.v FROM reach r JOIN sides b ON b.u = r.v),
members AS (SELECT u AS lei, min(v) AS cluster FROM reach GROUP BY u)"""
_RANK = "CASE WHEN starts_with(r.lei, 'SYNTH_') THEN '0' ELSE '1' END || coalesce(last_update_date::VARCHAR, '') || r.lei"
_KEPT = ", ".join(
    f"arg_max({c}, rank) FILTER ({c} <> '') AS {c}, arg_max(lei, rank) FILTER ({c} <> '') AS {c}_from" for c in merged.FIELDS
)
_FIELDS = ", ".join(merged.FIELDS)
MERGED = f"""records AS (SELECT lei, last_update_date, {_FIELDS} FROM real WHERE lei IS NOT NULL
  UNION ALL SELECT lei, last_update_date, {_FIELDS} FROM dup WHERE lei IS NOT NULL),
ranked AS (SELECT r.*, coalesce(cluster, r.lei) AS cluster, {_RANK} AS rank
  FROM records r LEFT JOIN members m ON m.lei = r.lei)"""


# --- versions and pages -------------------------------------------------------------------
def sink_b4_bucketed_upsert(spark, sf):
    """The upsert as two versions of a bucketed snapshot, read back."""
    before, load = Q._upsert_inputs(spark, sf)
    first = snapshots.create_snapshot(before, scratch_dir(spark, "snapshot"), "lei")
    rows = load.filter(merge.real_key())
    after = snapshots.upsert_snapshot(
        first, rows, "lei", lambda stored, new: merge.upsert_entities(stored, new, Q.AS_OF)
    )
    return Q._addresses(snapshots.open_snapshot(spark, first.path, after.version).read())


def _third_page(table, limit, where=None):
    cursor = None
    for _ in range(3):
        page, cursor = table.page(limit, cursor, where)
    return page


def search_h1_keyset_page(spark, sf):
    """The third page of active companies, each page by the cursor of the one before."""
    table = snapshots.write_ordered(
        Q.stored(spark, sf), scratch_dir(spark, "ordered"), [F.col("legal_name"), F.col("lei")], 16
    )
    return Q._addresses(_third_page(table, 40, F.col("entity_status") == "ACTIVE").drop("updated_at"))


def search_h2_keyset_page(spark, sf):
    """The third page of matches, best first."""
    table = snapshots.write_ordered(
        Q.matches(spark, sf), scratch_dir(spark, "ordered"), [-F.col("final_score"), F.col("id")], 16
    )
    return Q._codes(_third_page(table, 200))


# --- blocking ------------------------------------------------------------------------------
def er_x7_blocked_pairs(spark, sf):
    return blocking.blocked(Q.clean(spark, sf))[0]


def er_x7_refined_pairs(spark, sf):
    """Blocks of more than 20 records are refined, and laid out as grids of 20 if they stay."""
    return blocking.blocked(Q.clean(spark, sf), 20)[0]


def er_x7_classes(spark, sf):
    return blocking.classes(Q.clean(spark, sf))


def plain(x: str) -> str:
    return f"trim(regexp_replace(replace(lower({x}), '.', ''), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({plain(x)}, ' '), lambda w: w <> '')"


def own_words(source: str, out: str) -> str:
    """CTE ``out``: rows of ``source`` with ``words``, their name's distinct words in order."""
    return f"""{out}_0 AS (SELECT *, {words('normalized_name')} AS every FROM {source}),
{out}_1 AS (SELECT * EXCLUDE (every), list_filter(every, lambda w, i: list_position(every, w) = i) AS every FROM {out}_0),
{out}_2 AS (SELECT *, list_filter(every, lambda w: w NOT IN ({O.quoted(blocking.FORMS)})) AS own FROM {out}_1),
{out} AS (SELECT * EXCLUDE (every, own), CASE WHEN len(own) > 0 THEN own ELSE every END AS words FROM {out}_2)"""


SAME = "normalized_name, country, jurisdiction, legal_address_line1, legal_address_city"
CLASSES = f"""named AS (SELECT lei, {SAME}, {plain('normalized_name')} AS p FROM real WHERE lei IS NOT NULL),
classes AS (SELECT lei, min(lei) OVER (PARTITION BY {SAME}) AS same_as FROM named WHERE p <> '')"""


def pairs_sql(large: int) -> str:
    def ranked(column: str, keep: int, mark: str) -> str:
        return f"""SELECT lei, '{mark}' || term AS key FROM
    (SELECT lei, term, count(*) OVER (PARTITION BY term) AS n FROM (SELECT lei, unnest({column}) AS term FROM w))
    QUALIFY row_number() OVER (PARTITION BY lei ORDER BY n, term) <= {keep}"""

    levels = []
    for i, c in enumerate(blocking.REFINED_BY):
        levels.append(f"""k{i + 1} AS (SELECT lei, {", ".join(blocking.REFINED_BY)},
  CASE WHEN count(*) OVER (PARTITION BY key) > {large} THEN key || '|' || coalesce({c}, '') ELSE key END AS key FROM k{i})""")
    return f"""{CLASSES},
first AS (SELECT real.* FROM real JOIN classes USING (lei) WHERE lei = same_as),
{own_words('first', 'v')},
w AS (SELECT *, list_distinct(list_transform(range(1, greatest(length(array_to_string(words, '')) - 1, 2)),
  lambda i: substr(array_to_string(words, ''), i, 3))) AS pieces FROM v),
plain_keys AS ({ranked('words', blocking.WORDS, 'w:')}
  UNION ALL {ranked('pieces', blocking.PIECES, 'p:')}
  UNION ALL SELECT lei, 'c:' || coalesce(country, '') || ':' || substr(array_to_string(words, ''), 1, {blocking.PREFIX}) FROM w),
k0 AS (SELECT p.lei, key, {", ".join(blocking.REFINED_BY)} FROM plain_keys p JOIN first f USING (lei)),
{", ".join(levels)},
cand AS (SELECT DISTINCT a.lei AS lei_a, b.lei AS lei_b FROM k{len(levels)} a JOIN k{len(levels)} b USING (key) WHERE a.lei < b.lei)"""


# --- aliases and screening -------------------------------------------------------------------
def er_x5_aliases(spark, sf):
    return screening.alias_rows(Q.clean(spark, sf))


def search_x5_by_alias(spark, sf):
    """Stored companies one of whose other names contains the text."""
    found = search.entities_by_alias(Q.stored(spark, sf), screening.alias_rows(Q.clean(spark, sf)), "foods 1")
    return found.select("lei", "legal_name", "alias")


def _screened(spark, sf):
    rows = Q.clean(spark, sf)
    lines = watchlist.parse_lines(V.spark_view(spark, sf, V.SCREEN_LINES))
    return screening.screen(
        screening.company_names(rows, screening.alias_rows(rows)), screening.watch_names(lines)
    )


def er_x1_screening(spark, sf):
    return _screened(spark, sf)


def report_x1_risk_lines(spark, sf):
    """The hits as lines of the verification reports."""
    from orgkin.operators.reports import report_lines

    return report_lines(risk=_screened(spark, sf))


ALIASES = f"""other AS (SELECT DISTINCT lei, trim(unnest(other_names::JSON::VARCHAR[])) AS alias FROM real WHERE lei IS NOT NULL),
aliases AS (SELECT lei, alias, {O.name('alias')} AS normalized_alias FROM other WHERE alias <> '')"""
SCREENED = f"""{ALIASES},
mine AS (SELECT DISTINCT * FROM (SELECT lei, normalized_name, country FROM real
    UNION ALL SELECT lei, normalized_alias, real.country FROM aliases JOIN real USING (lei))
  WHERE lei IS NOT NULL AND normalized_name <> ''),
lines AS (SELECT value FROM ({V.duck_view(V.SCREEN_LINES)}) WHERE json_valid(value)),
theirs AS (SELECT DISTINCT * FROM (SELECT value->>'$.id' AS os_id, {O.name("said")} AS normalized_name,
    upper(value->>'$.properties.country[0]') AS country, dataset FROM (
      SELECT value, unnest((value->'$.properties.name')::VARCHAR[]) AS said,
        array_to_string((value->'$.datasets')::VARCHAR[], ',') AS dataset
      FROM lines WHERE value->>'$.schema' IN ({O.quoted(R.WATCHLIST_SCHEMAS)}))) WHERE normalized_name <> ''),
{own_words('(SELECT DISTINCT normalized_name FROM mine)', 'wa')},
{own_words('(SELECT DISTINCT normalized_name FROM theirs)', 'wb')},
near AS (SELECT a.normalized_name AS a, b.normalized_name AS b FROM wa a, wb b
  WHERE 2 * len(list_intersect(a.words, b.words)) >= least(len(a.words), len(b.words))
    AND len(list_intersect(a.words, b.words)) > 0
    AND least(length(a.normalized_name), length(b.normalized_name))
      >= {screening.length_ratio(screening.LINE)}::DOUBLE * greatest(length(a.normalized_name), length(b.normalized_name))),
{O.name_scores('near')},
hits AS (SELECT m.lei, t.os_id, t.normalized_name AS name, t.dataset, score, {O.same('m.country', 't.country')} AS same
  FROM name_scores n JOIN mine m ON m.normalized_name = n.a JOIN theirs t ON t.normalized_name = n.b
  WHERE score >= {screening.LINE}::DOUBLE),
screened AS (SELECT lei, os_id, name, dataset, score, max(same) OVER (PARTITION BY lei, os_id) AS country_match FROM hits
  QUALIFY row_number() OVER (PARTITION BY lei, os_id ORDER BY score DESC, name, dataset) = 1)"""


# --- benchmark ------------------------------------------------------------------------------
def _benchmark(spark, sf):
    """Every marked copy against its own company, and against the parent of that company."""
    fields = ["lei", "legal_name", "normalized_name", "legal_address_line1", "legal_address_city", "country", "jurisdiction"]
    dup = Q.duplicates(spark, sf)
    own = dup.select(F.col("origin_lei").alias("lei_a"), F.col("lei").alias("lei_b"))
    parents = V.spark_view(spark, sf, V.RELATIONSHIPS).select(
        F.col("parent_lei").alias("lei_a"), F.concat(F.lit(R.SYNTHETIC_PREFIX), "lei").alias("lei_b")
    )
    records = Q.clean(spark, sf).select(*fields).unionByName(dup.select(*fields))
    scored = resolve.score_pairs(resolve.side_rows(own.unionByName(parents), records))
    mark = resolve.noise_mark([F.col("origin_lei"), F.col("ingest_ord")])
    kinds = dup.select(F.col("lei").alias("lei_b"), "origin_lei", resolve.noise_kind(mark).alias("noise"))
    return benchmark.score_histogram(
        scored.join(kinds, "lei_b"), F.col("lei_a") == F.col("origin_lei"), ["noise"]
    )


def er_x4_histogram(spark, sf):
    return Q.staged(spark, sf, "benchmark", _benchmark)


def er_x4_curve(spark, sf):
    return benchmark.precision_recall(er_x4_histogram(spark, sf))


def er_x4_curve_by_noise(spark, sf):
    return benchmark.precision_recall(er_x4_histogram(spark, sf), ["noise"])


def er_x4_best_lines(spark, sf):
    return benchmark.best_lines(er_x4_curve_by_noise(spark, sf), ["noise"])


def er_x4_by_decision(spark, sf):
    return benchmark.by_decision(er_x4_histogram(spark, sf), ["noise"])


HISTOGRAM = f"""pairs AS (SELECT {O.pair_columns()} FROM dup b JOIN real a ON a.lei = b.origin_lei
  UNION ALL SELECT {O.pair_columns()} FROM ({V.duck_view(V.RELATIONSHIPS)}) r
  JOIN dup b ON b.lei = 'SYNTH_' || r.lei JOIN real a ON a.lei = r.parent_lei),
{O.scored('pairs', vector=False)},
hist AS (SELECT ([{O.quoted(resolve.NOISE_KINDS)}])[concat('0x', substr(md5(coalesce(origin_lei, '') || ':' || ingest_ord
    || ':noise99'), 1, 8))::BIGINT % 5 + 1] AS noise, decision,
  floor(final_score::DECIMAL(10, 4) * 100)::INT AS step, count(*) FILTER (lei_a = origin_lei) AS matches,
  count(*) FILTER (lei_a <> origin_lei) AS others FROM matches JOIN dup ON dup.lei = lei_b GROUP BY ALL)"""


def curve_sql(by: str) -> str:
    """CTE ``curve``: every line against every step of its group."""
    return f"""steps AS (SELECT {by} AS noise, step, sum(matches) AS m, sum(others) AS o FROM hist GROUP BY ALL),
found AS (SELECT a.noise, a.step, sum(b.m) FILTER (b.step >= a.step) AS tp, sum(b.o) FILTER (b.step >= a.step) AS fp,
  sum(b.m) FILTER (b.step < a.step) AS below FROM steps a JOIN steps b ON b.noise = a.noise GROUP BY 1, 2),
curve AS (SELECT noise, step::DOUBLE / 100 AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, coalesce(below, 0)::BIGINT AS fn,
  tp::DOUBLE / (tp + fp)::DOUBLE AS precision, tp::DOUBLE / (tp + coalesce(below, 0))::DOUBLE AS recall,
  (2 * tp)::DOUBLE / (2 * tp + fp + coalesce(below, 0))::DOUBLE AS f1 FROM found)"""


# --- addresses -------------------------------------------------------------------------------
SMALL_HUB = 3  # so that small tables have hubs


def _at_address(spark, sf):
    return addresses.address_members(Q.clean(spark, sf))


def graph_x6_address_nodes(spark, sf):
    return addresses.address_nodes(Q.clean(spark, sf))


def graph_x6_address_edges(spark, sf):
    return addresses.address_edges(Q.clean(spark, sf))


def graph_x6_co_located(spark, sf):
    return addresses.co_located(_at_address(spark, sf), SMALL_HUB)


def graph_x6_hub_members(spark, sf):
    return addresses.hub_members(_at_address(spark, sf), SMALL_HUB)


def graph_x6_sharing(spark, sf):
    return addresses.sharing(_at_address(spark, sf), SMALL_HUB)


ADDRESSES = "said AS (" + " UNION ALL ".join(
    f"SELECT lei, '{kind}' AS edge_type, concat_ws(' ', {', '.join(parts)}) AS text FROM real WHERE lei IS NOT NULL AND {parts[0]} <> ''"
    for kind, parts in addresses.PARTS.items()
) + f"""),
plain AS (SELECT lei, edge_type, trim(regexp_replace(upper({O.fold('text')}), '[^A-Z0-9]+', ' ', 'g')) AS label FROM said),
addresses AS (SELECT DISTINCT lei, edge_type, sha256(label) AS address_id, label FROM plain WHERE label <> ''),
members AS (SELECT *, count(*) OVER (PARTITION BY address_id) AS companies FROM (SELECT DISTINCT address_id, lei FROM addresses))"""


def linkage_queries():
    return {n: f for n, f in globals().items() if n.startswith(Q.PREFIXES) and callable(f)}


def linkage_oracles() -> dict[str, str]:
    def full(ctes: str, select: str) -> str:
        return f"WITH RECURSIVE {ctes}\n{select}"

    have = O.base_oracles()
    return {
        "src_a6_first_rows": f"SELECT * FROM ({have['src_a5_watchlist']}) ORDER BY os_id, os_name LIMIT 40",
        "src_a8_reused_extract": f"WITH {O.RAW} SELECT lei, ingest_ord FROM raw",
        "sink_b4_bucketed_upsert": have["sink_b4_upsert_entities"],
        "search_h1_keyset_page": full(f"{O.BASE},\n{O.STORED}", f"""SELECT {O.STORED_COLUMNS} FROM stored
  WHERE entity_status = 'ACTIVE' ORDER BY legal_name, lei LIMIT 40 OFFSET 80"""),
        "search_h2_keyset_page": full(O.MATCHES, f"""SELECT {O.MATCH_COLUMNS} FROM matches
  ORDER BY final_score DESC, id LIMIT 200 OFFSET 400"""),
        "graph_x2_ultimate_parents": full(CHAINS, "SELECT * FROM parents"),
        "graph_x2_control_groups": full(CHAINS, """SELECT ultimate_parent, count(*) AS companies, max(depth) AS deepest
  FROM parents WHERE ultimate_parent IS NOT NULL GROUP BY 1"""),
        "er_x3_clusters": full(f"{O.MATCHES},\n{CLUSTERS}", "SELECT * FROM members"),
        "er_x3_merged_records": full(f"{O.MATCHES},\n{CLUSTERS},\n{MERGED}", f"""SELECT cluster, count(*) AS records,
  count(*) FILTER (NOT starts_with(lei, 'SYNTH_')) AS real_records, {_KEPT} FROM ranked GROUP BY cluster"""),
        "er_x7_blocked_pairs": full(f"{O.BASE},\n{pairs_sql(blocking.LARGE)}", "SELECT * FROM cand"),
        "er_x7_refined_pairs": full(f"{O.BASE},\n{pairs_sql(20)}", "SELECT * FROM cand"),
        "er_x7_classes": full(f"{O.BASE},\n{CLASSES}", "SELECT * FROM classes"),
        "er_x5_aliases": full(f"{O.BASE},\n{ALIASES}", "SELECT * FROM aliases"),
        "search_x5_by_alias": full(f"{O.BASE},\n{ALIASES},\n{O.STORED}", """SELECT s.lei, legal_name, min(alias) AS alias
  FROM stored s JOIN aliases a ON a.lei = s.lei WHERE alias ILIKE '%foods 1%' OR normalized_alias ILIKE '%foods 1%'
  GROUP BY ALL"""),
        "er_x4_histogram": full(f"{O.BASE},\n{O.DUP},\n{HISTOGRAM}", "SELECT * FROM hist"),
        "er_x4_curve": full(f"{O.BASE},\n{O.DUP},\n{HISTOGRAM},\n" + curve_sql("''"), "SELECT * EXCLUDE (noise) FROM curve"),
        "er_x4_curve_by_noise": full(f"{O.BASE},\n{O.DUP},\n{HISTOGRAM},\n" + curve_sql("noise"), "SELECT * FROM curve"),
        "er_x4_best_lines": full(f"{O.BASE},\n{O.DUP},\n{HISTOGRAM},\n" + curve_sql("noise"), """SELECT * FROM curve
  QUALIFY row_number() OVER (PARTITION BY noise ORDER BY f1 DESC, threshold DESC) = 1"""),
        "er_x4_by_decision": full(f"{O.BASE},\n{O.DUP},\n{HISTOGRAM}", """SELECT noise, decision, sum(matches)::BIGINT AS matches,
  sum(others)::BIGINT AS others, sum(matches)::DOUBLE / (sum(matches) + sum(others))::DOUBLE AS precision FROM hist GROUP BY 1, 2"""),
        "graph_x6_address_nodes": full(f"{O.BASE},\n{ADDRESSES}",
            "SELECT DISTINCT 'Address' AS node_type, address_id AS id, label FROM addresses"),
        "graph_x6_address_edges": full(f"{O.BASE},\n{ADDRESSES}", """SELECT lei AS src, address_id AS dst, edge_type, 'Company' AS src_type,
  'Address' AS dst_type, NULL::DOUBLE AS final_score, NULL::VARCHAR AS decision FROM addresses"""),
        "graph_x6_co_located": full(f"{O.BASE},\n{ADDRESSES}", f"""SELECT a.lei AS lei_a, b.lei AS lei_b, count(*) AS addresses
  FROM members a JOIN members b USING (address_id) WHERE a.lei < b.lei AND a.companies <= {SMALL_HUB} GROUP BY 1, 2"""),
        "graph_x6_hub_members": full(f"{O.BASE},\n{ADDRESSES}", f"SELECT * FROM members WHERE companies > {SMALL_HUB}"),
        "graph_x6_sharing": full(f"{O.BASE},\n{ADDRESSES}", f"""SELECT lei, count(*) AS addresses,
  count(*) FILTER (companies > {SMALL_HUB}) AS hubs, sum(companies - 1)::BIGINT AS others FROM members GROUP BY 1"""),
        "er_x1_screening": full(f"{O.BASE},\n{SCREENED}", "SELECT * FROM screened"),
        "report_x1_risk_lines": full(f"{O.BASE},\n{SCREENED}", f"""SELECT lei, 3 AS section, name || ':' || dataset AS pos,
  name || ':' || dataset AS ref, name || ' (' || dataset || ', confidence: ' || printf('%.2f', {O.rounded('score', 2)}) || ')' AS line FROM screened"""),
    }
