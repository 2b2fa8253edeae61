"""Ownership chains, merged records, blocking and screening against brute force."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from checks import queries, views
from orgkin.functions import scoring
from orgkin.operators import blocking, merged, ownership, screening, search
from orgkin.sources import watchlist

TINY = "/root/testdata/sf0.001"
REL = "lei string, parent_lei string, relationship_type string, at string, depth string"


def _owned(spark, edges):
    rows = [(a, b, "DIRECT", "x", "y") for a, b in edges]
    return spark.createDataFrame(rows + [("z", "y", "OTHER", "", ""), (None, "a", "DIRECT", "", ""), ("z", None, "DIRECT", "", "")], REL)


def _chains(edges):
    """Every simple way up from every company, one after the other."""
    up = collections.defaultdict(set)
    for a, b in edges:
        up[a].add(b)
    out = set()
    for start in list(up):
        best, looped, ways = {}, False, [(start,)]
        while ways:
            way = ways.pop()
            for parent in up[way[-1]]:
                if parent in way:
                    looped = True
                elif parent in up:
                    ways.append((*way, parent))
                else:
                    found = (len(way), (*way, parent))
                    best[parent] = min(best.get(parent, found), found)
        for parent, (depth, way) in (best or {None: (None, None)}).items():
            out.add((start, parent, depth, way, looped))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_ultimate_parents_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([8, 15, 30])
    edges = {(f"n{rng.randrange(n):02}", f"n{rng.randrange(n):02}") for _ in range(int(n * 1.2))}
    edges |= {("s", "s"), ("t", "n00"), ("t", "top")}
    got = {
        (r.lei, r.ultimate_parent, r.depth, tuple(r.path) if r.path else None, r.in_cycle)
        for r in ownership.ultimate_parents(_owned(spark, [*edges, *edges])).collect()
    }
    assert got == _chains(edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ownership, "scratch_dir", lambda s, n, own=ownership.scratch_dir: written.append(n) or own(s, n))
    chain = [(f"c{i:04}", f"c{i + 1:04}") for i in range(600)]
    got = {r.lei: (r.ultimate_parent, r.depth, len(r.path)) for r in ownership.ultimate_parents(_owned(spark, chain)).collect()}
    assert got == {a: ("c0600", 600 - i, 601 - i) for i, (a, _) in enumerate(chain)}
    assert len(written) <= 12


def test_a_hot_parent_and_nothing(spark):
    edges = [(f"n{i:03}", "hot") for i in range(300)] + [("hot", "top")]
    rows = ownership.ultimate_parents(_owned(spark, edges))
    assert {(r.ultimate_parent, r.depth) for r in rows.collect()} == {("top", 2), ("top", 1)}
    assert [tuple(r) for r in ownership.control_groups(rows).collect()] == [("top", 301, 2)]
    assert ownership.ultimate_parents(_owned(spark, [])).collect() == []


def _components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in list(root)}


@pytest.mark.parametrize("shape", ["shuffled", "hub", "random"])
def test_clusters_are_those_of_brute_force(spark, shape):
    rng = random.Random(7)
    names = [f"k{i:04}" for i in range(1001)]
    rng.shuffle(names)
    pairs = {
        "shuffled": list(itertools.pairwise(names)),
        "hub": [(names[0], x) for x in names[1:400]],
        "random": [(rng.choice(names), rng.choice(names)) for _ in range(500)],
    }[shape]
    table = spark.createDataFrame([*pairs, *pairs, ("own", "own"), (None, "x")], "lei_a string, lei_b string")
    got = {tuple(r) for r in merged.clusters(table).collect()}
    assert got == {x for x in _components([p for p in pairs if p[0] != p[1]])}


def test_clusters_of_nothing(spark):
    assert merged.clusters(spark.createDataFrame([], "lei_a string, lei_b string")).collect() == []


def test_every_value_of_a_merged_record_has_its_source(spark):
    rows = [
        ("b", "Old Name", None, "2020-01-01"), ("a", "New Name", " ", "2023-01-01"), ("SYNTH_b", "Copied", "US", "2024-01-01"),
        ("c", "", "DE", None), ("alone", None, None, None), (None, "no key", "FR", None),
    ]
    table = spark.createDataFrame(rows, "lei string, legal_name string, country string, last_update_date string")
    members = spark.createDataFrame([(x, "a") for x in ("a", "b", "c", "SYNTH_b")], "lei string, cluster string")
    got = {r.cluster: r.asDict() for r in merged.merged_records(table, members, ("legal_name", "country")).collect()}
    assert got["a"] == {
        "cluster": "a", "records": 4, "real_records": 3, "legal_name": "New Name", "legal_name_from": "a",
        "country": " ", "country_from": "a",
    }
    assert got["alone"]["records"] == 1 and got["alone"]["legal_name"] is None and len(got) == 2


@pytest.fixture(scope="module")
def companies(spark):
    return queries.clean(spark, TINY)


def _keys(spark, rows, large):
    """Refined keys of each record, by hand from the unrefined ones."""
    plain = collections.defaultdict(set)
    for r in blocking.block_keys(rows, 10**9).collect():
        plain[r.lei].add(r.key)
    values = {r.lei: [r[c] or "" for c in blocking.REFINED_BY] for r in rows.collect()}
    for level in range(len(blocking.REFINED_BY)):
        sizes = collections.Counter(k for keys in plain.values() for k in keys)
        plain = {
            lei: {f"{k}|{values[lei][level]}" if sizes[k] > large else k for k in keys} for lei, keys in plain.items()
        }
    return plain


@pytest.mark.parametrize("large", [500, 5])
def test_pairs_form_once_and_blocks_are_not_cut(spark, companies, large):
    rows = companies.orderBy("lei").limit(300)
    rows = rows.filter("normalized_name IS NOT NULL AND lei IS NOT NULL")
    keys = _keys(spark, rows, large)
    want = {(a, b) for a, b in itertools.combinations(sorted(keys), 2) if keys[a] & keys[b]}
    got = [tuple(r) for r in blocking.candidate_pairs(rows, large).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_pair_recall_against_all_pairs(spark, companies):
    """Pairs with like names that blocking finds, of all there are."""
    shown = ["lei", *blocking._SAME]
    records = companies.select(shown).unionByName(queries.duplicates(spark, TINY).select(shown))
    pairs, same = blocking.blocked(records)
    first = records.join(same.filter("lei = same_as").select("lei"), "lei", "left_semi").select("lei", "normalized_name")
    a, b = first.toDF("lei_a", "a"), first.toDF("lei_b", "b")
    every = scoring.with_signals(a.join(b, F.col("lei_a") < F.col("lei_b")), name=("a", "b"))
    alike = every.filter("name_similarity >= 0.85").select("lei_a", "lei_b").persist()
    found = alike.join(pairs, ["lei_a", "lei_b"], "left_semi").count()
    assert alike.count() > 100 and found >= 0.99 * alike.count()


def test_one_hot_country_makes_no_large_cell(spark):
    rows = spark.range(3000).select(
        F.format_string("L%05d", "id").alias("lei"), F.format_string("Acme Trading %d", F.col("id") % 40).alias("normalized_name"),
        F.lit("US").alias("country"), F.lit("J").alias("jurisdiction"), F.lit("Main St").alias("legal_address_line1"),
        F.concat(F.lit("City"), (F.col("id") % 3).cast("string")).alias("legal_address_city"),
    )
    cells = blocking._cells(blocking.block_keys(rows, 50), 50)
    assert cells.groupBy("key", "low", "high").count().agg(F.max("count")).first()[0] < 200
    pairs, same = blocking.blocked(rows, 50)
    assert same.filter("lei = same_as").count() == 120 and same.count() == 3000
    assert pairs.count() == pairs.distinct().count()


def test_classes_take_nulls_as_equal(spark):
    rows = spark.createDataFrame(
        [("b", "X Inc", None, None, None, None), ("a", "X Inc", None, None, None, None), ("c", "X Inc", "US", None, None, None),
         ("d", " . ", None, None, None, None), (None, "X Inc", None, None, None, None)],
        "lei string, normalized_name string, country string, jurisdiction string, legal_address_line1 string, legal_address_city string")
    assert {tuple(r) for r in blocking.classes(rows).collect()} == {("a", "a"), ("b", "a"), ("c", "c")}
    assert blocking.blocked(rows.limit(0))[0].collect() == []


def test_aliases(spark):
    rows = spark.createDataFrame(
        [("a", '["Old Inc", " Old Inc ", "", null]'), ("b", "no list"), ("c", None), ("d", "[]"), (None, '["x"]'), ("e", '["Größe Ltd."]')],
        "lei string, other_names string")
    found = screening.alias_rows(rows)
    assert {(r.lei, r.alias) for r in found.collect()} == {("a", "Old Inc"), ("e", "Größe Ltd.")}
    stored = spark.createDataFrame([("a", 1), ("e", 2), ("f", 3)], "lei string, v int")
    assert [r.lei for r in search.entities_by_alias(stored, found, "größe").collect()] == ["e"]


def test_screening_finds_what_brute_force_finds(spark, companies):
    lines = views.spark_view(spark, TINY, views.SCREEN_LINES)
    watched = screening.watch_names(watchlist.parse_lines(lines))
    names = screening.company_names(companies, screening.alias_rows(companies))
    words = {n: None for n in {r.name for r in names.collect()} | {r.name for r in watched.collect()}}
    table = spark.createDataFrame([(n,) for n in words], "name string").select("name", blocking.name_words("name").alias("w"))
    words = {r.name: set(r.w) for r in table.collect()}
    near = [
        (a, b) for a in {r.name for r in names.collect()} for b in {r.name for r in watched.collect()}
        if words[a] & words[b] and 2 * len(words[a] & words[b]) >= min(len(words[a]), len(words[b]))
    ]
    scored = scoring.with_signals(spark.createDataFrame(near, "a string, b string"), name=("a", "b"))
    want = {(r.a, r.b, r.name_similarity) for r in scored.filter("name_similarity >= 0.85").collect()}
    got = [tuple(r) for r in screening.similar_names(names, watched).collect()]
    assert len(got) == len(set(got)) > 5 and set(got) == want
    by_name = {(a, b): s for a, b, s in want}
    hits = collections.defaultdict(float)
    for c in names.collect():
        for w in watched.collect():
            if (c.name, w.name) in by_name:
                hits[c.key, w.key] = max(hits[c.key, w.key], by_name[c.name, w.name])
    assert {(r.lei, r.os_id): r.score for r in screening.screen(names, watched).collect()} == hits


def test_screening_meets_aliases_of_both_sides(spark):
    rows = spark.createDataFrame(
        [("a", "Quite Different Ltd", "DE", '["Zeta Holding AG"]'), ("b", "Plain Name", None, None), ("c", None, "US", None)],
        "lei string, normalized_name string, country string, other_names string")
    lines = spark.createDataFrame(
        [('{"id":"w1","schema":"Company","datasets":["ofac"],"properties":{"name":["Other","ZETA HOLDING AG"],"country":["de"]}}',),
         ('{"id":"w2","schema":"Person","datasets":[],"properties":{"name":["Plain Name"]}}',),
         ('{"id":"w3","schema":"Company","properties":{}}',)], "value string")
    watched = screening.watch_names(watchlist.parse_lines(lines))
    names = screening.company_names(rows, screening.alias_rows(rows))
    assert [tuple(r) for r in screening.screen(names, watched).collect()] == [("a", "w1", "Zeta Holding AG", "ofac", 1.0, 1.0)]
    assert screening.screen(names, watched.limit(0)).collect() == []
