"""Operators on small fixtures, with brute-force answers where there is no SQL."""

import datetime as dt
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from orgkin import schemas
from orgkin.operators import graph, keyed, merge, quality, reports, resolve, review, search, vectors
from orgkin.operators.clean import clean_entities, stage_boundary
from orgkin.plans.daily import run_daily
from orgkin.sources import registry, tables, watchlist

AS_OF = dt.datetime(2024, 6, 1)


def entity(lei, name, city="New York", country="US", jurisdiction="Delaware", line="123 Main St"):
    return (lei, name, name, line, city, country, jurisdiction)


SIDE = ("lei string, legal_name string, normalized_name string, legal_address_line1 string, "
        "legal_address_city string, country string, jurisdiction string")


def scored(spark, a, b, va=None, vb=None, **options):
    left = spark.createDataFrame([a], SIDE)
    right = spark.createDataFrame([("SYNTH_" + a[0], *b[1:])], SIDE)
    v = None
    if va is not None:
        v = spark.createDataFrame([(a[0], va), ("SYNTH_" + a[0], vb)], schemas.VECTORS)
    return resolve.resolve(left, right, v, **options).collect()[0]


def test_identical_records(spark):
    a = entity("LEI001", "Apple Inc")
    row = scored(spark, a, a)
    assert (row.final_score, row.decision) == (0.8, "needs_review")
    assert row.reason_codes == ["similar_name", "similar_address", "same_country",
                                "same_jurisdiction"]
    assert row.embedding_similarity == 0.0
    row = scored(spark, a, a, [1.0, 2.0], [1.0, 2.0])
    assert (row.final_score, row.decision) == (1.0, "same_entity")
    row = scored(spark, a, a, renormalise_missing=True)
    assert (row.final_score, row.decision) == (1.0, "same_entity")
    row = scored(spark, a, a, [1.0, 0.0], [-1.0, 0.0])
    assert (row.embedding_similarity, row.final_score) == (0.0, 0.8)


def test_different_records(spark):
    row = scored(spark, entity("LEI001", "Apple Inc"),
                 entity("LEI002", "Deutsche Bank AG", "Frankfurt", "DE", "Germany"))
    assert row.decision == "different_entity" and row.final_score < 0.65


def test_results_do_not_depend_on_partitions(spark):
    raw = registry.fallback_registry(spark, 200).withColumn("ingest_ord", F.col("lei"))
    clean = clean_entities(raw)

    def run(n):
        dup = clean_entities(resolve.labelled_duplicates(raw.repartition(n), 50))
        return sorted((r.id, r.final_score) for r in resolve.resolve(clean, dup).collect())

    assert run(1) == run(7) and len(run(3)) == 50


def test_keyed_join_salts_hot_keys(spark, plan, tmp_path):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(3000)]
    spark.createDataFrame(rows + [(-1, None)], "i int, k string").write.parquet(str(tmp_path / "m"))
    many = spark.read.parquet(str(tmp_path / "m"))
    one = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    for how in ("inner", "left", "left_semi"):
        plain = many.join(one, "k", how)
        salted = keyed.keyed_join(many, one, "k", how, salted=True, hot_rows=500)
        assert salted.columns == plain.columns
        assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))
    assert "AS _salt" in plan(keyed.keyed_join(many, one, "k", salted=True, hot_rows=500))
    assert "AS _salt" not in plan(keyed.keyed_join(many, one, "k"))
    hot = keyed.hot_keys(many, "k", 500).collect()
    assert [r.k for r in hot] == ["hot"]


def test_first_per_key_prunes_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    first = keyed.first_per_key(df, ["k"], F.asc("id"))
    assert plan(first).count("WindowGroupLimit") == 2
    assert sorted(tuple(r) for r in first.collect()) == [(0, 0), (1, 1)]


def test_exact_sample_sizes(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    whole = keyed.exact_sample(df, 700, 42, ["id"])
    want = sorted(r.id for r in whole.collect())
    assert len(want) == 700
    again = keyed.exact_sample(df.repartition(9), 700, 42, ["id"])
    assert sorted(r.id for r in again.collect()) == want
    monkeypatch.setattr(keyed, "IN_ONE_GO", 50)
    narrowed = keyed.exact_sample(df, 700, 42, ["id"])
    assert sorted(r.id for r in narrowed.collect()) == want
    assert keyed.exact_sample(df, 9999, 42, ["id"]).count() == 5000
    other = keyed.exact_sample(df, 700, 43, ["id"])
    assert sorted(r.id for r in other.collect()) != want


def test_noise_covers_every_kind(spark):
    names = ["Acme Inc.", "North Street Corp.", "Plain Name", "A,B.C Ltd.", "Tiny", "X LLC"]
    df = spark.createDataFrame([(n, i) for n in names for i in range(600)], "n string, i int")
    rows = df.select("n", resolve.noisy_name("n", F.col("i").cast("string")).alias("out")).collect()
    seen = {n: {r.out for r in rows if r.n == n} for n in names}
    assert {"Acme Incorporated", "ACME INC.", "acme inc.", "Acme Inc", "Acme Inc. LLC"} <= seen[
        "Acme Inc."]
    assert {"North St. Corp.", "North Street Corporation"} <= seen["North Street Corp."]
    assert {"Plain Name LLC", "Plaain Name"} <= seen["Plain Name"]
    assert {"X", "X L.L.C.", "X Llc"} <= seen["X LLC"]
    assert "AB.C Ltd." not in seen["A,B.C Ltd."] and "ABC Ltd" in seen["A,B.C Ltd."]
    assert seen["Tiny"] == {"Tiny LLC", "TINY", "tiny", "Tiny"}


# --- quality ------------------------------------------------------------------------------
def test_quality_counts(spark, plan):
    df = spark.createDataFrame(
        [("a", "x", "US", "ACTIVE", "l"), ("a", " ", "HK", "UNKNOWN", None), (None, None, None, None, None),
         (None, "y", "NA", "MERGED", "l")],
        "lei string, legal_name string, country string, entity_status string, "
        "legal_address_line1 string",
    )
    row = quality.flat_checks(quality.quality_metrics(df, AS_OF)).collect()[0]
    assert (row.total_records, row.valid_records, row.invalid_records) == (4, 1, 3)
    assert (row.missing_lei_count, row.missing_name_count, row.duplicate_lei_count) == (2, 1, 2)
    assert (row.invalid_country_count, row.invalid_status_count) == (1, 1)
    assert (row.missing_name_rate, row.missing_address_rate, row.data_quality_score) == (
        0.25, 0.5, 25.0)
    assert not any([row.lei_not_null, row.no_duplicate_lei, row.missing_address_below_30pct])


def test_quality_of_empty_and_narrow_tables(spark):
    empty = quality.quality_metrics(spark.createDataFrame([], schemas.REGISTRY)).collect()[0]
    assert (empty.total_records, empty.data_quality_score, empty.valid_records) == (0, 0.0, None)
    narrow = quality.quality_metrics(spark.range(3)).collect()[0]
    assert (narrow.missing_lei_count, narrow.missing_name_count) == (3, 3)
    assert (narrow.duplicate_lei_count, narrow.missing_address_rate) == (0, 0.0)
    assert (narrow.valid_records, narrow.data_quality_score) == (3, 100.0)


# --- merge ---------------------------------------------------------------------------------
@pytest.mark.parametrize("small", [True, False])
def test_upsert_is_idempotent(spark, small):
    cols = "k string, a string, b string"
    old = spark.createDataFrame([("1", "x", "p"), ("2", "y", None)], cols)
    new = spark.createDataFrame([("2", None, "q"), ("3", "z", "r")], cols)
    once = merge.merge_snapshot(old, new, "k", ["a"], small)
    want = [("1", "x", "p"), ("2", None, None), ("3", "z", "r")]
    assert sorted(map(tuple, once.collect())) == want
    twice = merge.merge_snapshot(once, new, "k", ["a"], small)
    assert sorted(map(tuple, twice.collect())) == want


def test_small_upsert_does_not_shuffle_the_target(spark, plan, tmp_path):
    spark.range(1000).selectExpr("string(id) AS k", "string(id) AS a").write.parquet(
        str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    spark.createDataFrame([("2", "q")], "k string, a string").write.parquet(str(tmp_path / "n"))
    new = spark.read.parquet(str(tmp_path / "n"))
    text = plan(merge.merge_snapshot(old, new, "k", ["a"], small_source=True))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_repeated_source_keys(spark):
    rows = spark.createDataFrame(
        [("1", 1, "a1", "b1"), ("1", 2, "a2", "b2"), ("2", 3, "a3", "b3")],
        "k string, o int, a string, b string")
    assert sorted(map(tuple, merge.fold_source(rows, "k", ["a"], "o").collect())) == [
        ("1", "a2", "b1"), ("2", "a3", "b3")]


def test_new_rows_only_once(spark):
    stored = spark.createDataFrame([("1",)], "id string")
    incoming = spark.createDataFrame([("1", 0), ("2", 5), ("2", 5)], "id string, v int")
    assert [tuple(r) for r in merge.new_rows(stored, incoming).collect()] == [("2", 5)]


# --- graph and reports ----------------------------------------------------------------------
def small_graph(spark):
    rows = spark.createDataFrame(
        [("A", "Alpha", "US", "Delaware"), ("B", "Beta", "US", None), ("C", None, None, "US")],
        "lei string, legal_name string, country string, jurisdiction string")
    nodes = graph.entity_nodes(rows)
    matches = spark.createDataFrame(
        [("1", "A", "B", 0.9, "same_entity"), ("2", "A", "Z", 0.9, "same_entity"),
         ("3", "B", "C", 0.1, "different_entity")],
        "id string, lei_a string, lei_b string, final_score double, decision string")
    owned = tables.relationships(spark, [
        {"lei": "B", "parent_lei": "A", "relationship_type": "DIRECT"},
        {"lei": "B", "parent_lei": "A", "relationship_type": "OTHER"},
        {"lei": "B", "parent_lei": "Q", "relationship_type": "ULTIMATE"}])
    edges = graph.entity_edges(rows).unionByName(graph.match_edges(matches, nodes)).unionByName(
        graph.ownership_edges(owned, nodes))
    return nodes, edges


def test_neighbourhood(spark):
    nodes, edges = small_graph(spark)
    keys = spark.createDataFrame([("B",), ("NOPE",)], "key string")
    got = sorted(map(tuple, graph.neighbourhood_nodes(nodes, edges, keys).collect()))
    assert got == [("B", "A", "Alpha", "Company"), ("B", "B", "Beta", "Company"),
                   ("B", "US", "US", "Country")]
    links = sorted(map(tuple, graph.neighbourhood_edges(edges, keys).collect()))
    assert links == [("B", "A", "B", "MATCHED_TO"), ("B", "B", "A", "HAS_DIRECT_PARENT"),
                     ("B", "B", "US", "LOCATED_IN")]
    listed = sorted(map(tuple, graph.relationship_list(nodes, edges, keys).collect()))
    assert listed == [("B", "HAS_DIRECT_PARENT", "Alpha", "A", "Company"),
                      ("B", "LOCATED_IN", "US", "", "Country")]


def test_long_reports_continue_on_pages(spark):
    stored = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "lei string, legal_name string")
    stored = schemas.conform(stored, schemas.STORED_ENTITIES)
    links = spark.range(500).select(
        F.lit("A").alias("key"), F.lit("MATCHED_TO").alias("rel_type"),
        F.lit("same label").alias("target_label"), F.col("id").cast("string").alias("target_lei"))
    made = reports.verification_reports(stored, reports.report_lines(relationships=links),
                                        page_lines=50)
    rows = made.collect()
    pages = [r.report_text for r in rows if r.lei == "A"]
    assert sum(p.count("- MATCHED_TO → same label") for p in pages) == 500
    assert len(pages) == 10 and max(p.count("\n- ") for p in pages) < 150
    only = [r.report_text for r in rows if r.lei == "B"]
    assert len(only) == 1 and only[0].count("None identified") == 4


def test_explanation_and_risk_lines(spark):
    row = spark.createDataFrame(
        [("1", "A", "B", 0.98, 0.125, 0.0, 1.0, 0.0, 0.5432, "needs_review", [])],
        "id string, name_a string, name_b string, name_similarity double, "
        "address_similarity double, embedding_similarity double, country_match double, "
        "jurisdiction_match double, final_score double, decision string, "
        "reason_codes array<string>")
    text = reports.explain_matches(row).collect()[0].explanation
    assert "0.54 (name 0.98, address 0.12, vector 0.00; same country: Yes" in text
    assert "same jurisdiction: No; reasons: none" in text
    risk = spark.createDataFrame([("A", "Bad Co", "ofac", 0.875)],
                                 "lei string, name string, dataset string, score double")
    assert reports.report_lines(risk=risk).collect()[0].line == "Bad Co (ofac, confidence: 0.88)"


def test_query_parsing(spark):
    df = spark.createDataFrame([(1, "Active banks in Germany"), (2, "funds registered in Delaware"),
                                (3, "pending transfer cases")], "query_id int, text string")
    rows = {r.query_id: r for r in reports.parse_queries(df).collect()}
    assert (rows[1].parsed_country, rows[1].parsed_entity_status) == ("DE", "ACTIVE")
    assert rows[2].parsed_jurisdiction == "Delaware" and rows[2].parsed_country is None
    assert rows[3].parsed_entity_status == "PENDING_TRANSFER"


# --- search and review -----------------------------------------------------------------------
def test_pages_use_top_k(spark, plan):
    df = spark.range(1000).select(
        *[F.col("id").cast("string").alias(c) for c in
          ("id", "lei", "legal_name", "normalized_name", "country", "jurisdiction",
           "entity_status")])
    page = search.search_entities(df, query="1", limit=5, offset=2)
    assert [r.lei for r in page.collect()] == ["100", "101", "102", "103", "104"]
    assert "TakeOrderedAndProject" in plan(page)
    with pytest.raises(ValueError):
        search.search_entities(df, limit=101)
    with pytest.raises(ValueError):
        search.match_page(df, limit=201)


def test_reviews(spark):
    with pytest.raises(ValueError):
        review.review_row(spark, "1", "maybe", AS_OF)
    log = review.review_row(spark, "1", "accepted", AS_OF).unionByName(
        review.review_row(spark, "1", "rejected", AS_OF, 1)).unionByName(
        review.review_row(spark, "9", "accepted", AS_OF))
    matches = spark.createDataFrame([("1",), ("2",)], "id string")
    rows = {r.id: r.reviewer_decision for r in review.with_reviews(matches, log).collect()}
    assert rows == {"1": "rejected", "2": None}
    assert [r.id for r in review.unknown_reviews(matches, log).collect()] == ["9"]
    counts = review.review_counts(review.with_reviews(matches, log)).collect()[0]
    assert (counts.reviewed, counts.pending) == (1, 1)


def test_latest_quality_falls_back(spark):
    runs = spark.createDataFrame([("1", AS_OF)], "id string, run_date timestamp_ntz")
    assert search.latest_quality(None, runs).collect()[0].id == "1"
    assert search.latest_run(runs.limit(0)).collect() == []


# --- vectors ---------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(5)
    rows = [(f"L{i:04d}", [float(rng.choice((-2, -1, 1, 2))) for _ in range(4)],
             rng.choice(("US", "DE")), rng.choice(("ACTIVE", "MERGED"))) for i in range(400)]
    ent = spark.createDataFrame([(k, c, s) for k, _, c, s in rows],
                                "lei string, country string, entity_status string")
    ent = schemas.conform(ent, schemas.ENTITIES)
    vec = spark.createDataFrame([(k, v) for k, v, *_ in rows], schemas.VECTORS)
    return rows, vectors.index_rows(ent, vec).cache()


@pytest.mark.parametrize("limit", [4096, 3])
def test_top_k_against_brute_force(spark, points, limit):
    """Many equal vectors: ties go by key, in the broadcast and in the grid form."""
    rows, index = points
    asks = [(i, rows[i][1], rows[i][2] if i % 2 else None) for i in range(12)]
    queries = spark.createDataFrame(asks, "query_id int, vector array<float>, country string")
    got = vectors.search_batch(index, queries, 6, max_queries=limit).collect()

    def cos(a, b):
        n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b)) / (n + 1e-9)

    for i, v, country in asks:
        best = sorted((-round(cos(v, w), 6), k) for k, w, c, _ in rows if country in (None, c))
        mine = [r.lei for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])]
        assert mine == [k for _, k in best[:6]]


def test_grid_with_many_blocks(spark, points, monkeypatch):
    _, index = points
    queries = index.select(F.col("lei").alias("query_id"), F.col("embedding").alias("vector"))
    want = vectors.search_batch(index, queries, 3).collect()
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 4 * 70)
    got = vectors.search_batch(index, queries, 3, max_queries=1).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_filter_reaches_the_scan(spark, points, plan, tmp_path):
    points[1].write.parquet(str(tmp_path / "i"))
    found = vectors.semantic_search(spark.read.parquet(str(tmp_path / "i")), [1.0, 0, 0, 0], 5,
                                    country="us")
    assert "EqualTo(country,US)" in plan(found)
    assert {r.country for r in found.collect()} == {"US"}


def test_point_ids(spark):
    row = spark.createDataFrame([("LEI001",)], "lei string").select(vectors.point_id("lei")).first()
    assert row[0] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "LEI001"))


def test_same_profile_same_vector(spark):
    rows = schemas.conform(spark.createDataFrame(
        [("A", "Alpha"), ("B", "Alpha"), ("C", "Gamma Mining")], "lei string, legal_name string"),
        schemas.ENTITIES)
    model = vectors.fit_embedder(rows, 64)
    made = {r.lei: list(r.embedding) for r in vectors.embed(rows, model).collect()}
    assert made["A"] == made["B"] != made["C"] and len(made["A"]) == 64

    def constant(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("lei"), pa.array([[1.0]] * b.num_rows, pa.list_(pa.float32()))],
                names=["lei", "embedding"])

    assert {tuple(r.embedding) for r in vectors.embed(rows, provider=constant).collect()} == {(1.0,)}


# --- sources and the batch -------------------------------------------------------------------
def test_registry_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'LEI,Entity.LegalName,Extra,Entity.LegalAddress.Country\n'
        'L1,"Quoted ""Best"", Inc.",x,NA\nL2,,y,\n')
    rows = registry.read_registry(spark, str(tmp_path / "r.csv"), None)
    assert rows.schema == schemas.REGISTRY
    got = {r.lei: (r.legal_name, r.country, r.hq_country) for r in rows.collect()}
    assert got == {"L1": ('Quoted "Best", Inc.', "NA", None), "L2": (None, None, None)}
    assert registry.read_registry(spark, str(tmp_path / "r.csv"), 1).count() == 1
    first = registry.fallback_registry(spark).orderBy("lei").first()
    assert (first.lei, first.legal_name) == ("LEI000000000000000001", "Sample Company 1 Inc.")


def test_watchlist(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"id":"2","schema":"Company","datasets":["a","b"],"properties":{"name":["N","M"]}}\n\n'
        '{"id":"1","schema":"LegalEntity","properties":{"country":["us"]}}\n'
        '{"id":"3","schema":"Person"}\n{"broken\n')
    parsed = watchlist.parse_lines(spark.read.text(str(tmp_path / "w.json")))
    assert watchlist.corrupt_lines(parsed).first()[0] == 1
    got = sorted(tuple(r) for r in watchlist.read_watchlist(spark, str(tmp_path / "w.json")).collect())
    assert got == [("1", "", "us", "LegalEntity", ""), ("2", "N", "", "Company", "a,b")]
    assert len(watchlist.watchlist_rows(parsed, 1).collect()) == 1


def test_reuse_and_missing_paths(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "x")
    assert tables.read_or_build(spark, path, build).count() == 3
    assert tables.read_or_build(spark, path, build).count() == 3 and len(calls) == 1
    assert tables.read_vectors(spark, str(tmp_path / "none")).schema == schemas.VECTORS
    assert tables.read_quality_reports(spark, str(tmp_path / "none")) is None


def test_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ids")
    for _ in range(2):
        assert len(tables.ensure_tables(spark, "ids.")) == 4
    run = tables.quality_run_row(quality.quality_metrics(spark.range(2), AS_OF))
    tables.append_table(run, "ids.data_quality_runs")
    assert tables.read_table(spark, "ids.data_quality_runs").first().total_records == 2


def test_daily_batch_twice(spark, tmp_path):
    raw = registry.fallback_registry(spark, 60).withColumn("ingest_ord", F.col("lei"))
    one = run_daily(spark, raw, str(tmp_path / "1"), AS_OF, "r1", 20, dimensions=32)
    assert one.rows["clean_entities"] == 60 and one.rows["matches"] == 20
    later = AS_OF + dt.timedelta(days=1)
    two = run_daily(spark, raw, str(tmp_path / "2"), later, "r2", 20, previous=one, dimensions=32)
    assert two.rows["match_table"] == 20 and two.rows["entities"] == 60
    kept = spark.read.parquet(two.path("entities")).first()
    assert (kept.created_at, kept.updated_at) == (AS_OF, later)
    report = tables.read_quality_reports(spark, one.path("quality_reports"))
    runs = spark.read.parquet(one.path("quality_runs"))
    assert search.latest_quality(report, runs).first().total_records == 60
    clean = stage_boundary(spark.read.parquet(one.path("clean_entities")))
    assert clean.filter(F.col("legal_address_line1").isNotNull()).count() == 0


def test_daily_batch_links_copies_if_asked(spark, tmp_path):
    raw = registry.fallback_registry(spark, 40).withColumns({
        "ingest_ord": F.col("lei"), "legal_address_line1": F.lit("1 Main Street"), "legal_address_city": F.lit("Dover"),
    })
    linked = []
    for asked in (False, True):
        run = run_daily(spark, raw, str(tmp_path / str(asked)), AS_OF, "r", 20, dimensions=32, copies_in_graph=asked)
        linked.append(spark.read.parquet(run.path("edges")).filter("edge_type = 'MATCHED_TO'").count())
    assert linked[0] == 0 < linked[1] <= 20


def test_reads_keep_all_rows_unless_asked(spark):
    import inspect

    from orgkin.operators import keyed, resolve
    from orgkin.plans import daily
    from orgkin.sources import registry, watchlist

    for function, name in (
        (watchlist.watchlist_rows, "cap"), (watchlist.read_watchlist, "cap"), (registry.read_registry, "n"),
        (resolve.labelled_duplicates, "n"), (daily.run_daily, "duplicates"),
    ):
        assert inspect.signature(function).parameters[name].default is None
    assert keyed.exact_sample(spark.range(5), 0, 1, ["id"]).count() == 0


def test_search_text_with_a_backslash(spark):
    from orgkin.operators.search import _contains

    rows = spark.createDataFrame([("a\\b",), ("ab",)], "n string")
    assert [r.n for r in rows.filter(rows.n.ilike(_contains("a\\b"))).collect()] == ["a\\b"]


def test_upsert_folds_repeated_keys(spark):
    load = spark.createDataFrame(
        [("A", "first", 1, "US"), ("B", "b1", 2, "DE"), ("A", "last", 3, "FR"), ("B", "b2", 4, "DE")],
        "lei string, legal_name string, ingest_ord int, country string")
    stored = merge.entity_rows(load, AS_OF).limit(0)
    got = merge.upsert_entities(stored, load, AS_OF).select("lei", "legal_name", "country").collect()
    assert sorted(map(tuple, got)) == [("A", "last", "US"), ("B", "b2", "DE")]


def test_new_rows_keep_the_earliest(spark):
    rows = [("1", "2024-02-01", 0.9), ("1", "2024-01-01", 0.5), ("1", "2024-01-01", 0.7)]
    incoming = spark.createDataFrame(rows, "id string, created_at string, final_score double")
    stored = spark.createDataFrame([], "id string")
    for order in (incoming, incoming.orderBy("final_score")):
        assert [tuple(r) for r in merge.new_rows(stored, order).collect()] == [rows[2]]


def test_elapsed_covers_the_work(spark):
    import time

    started = time.time() - 5
    row = quality.timed(quality.quality_metrics(spark.range(3), AS_OF), started).collect()[0]
    assert 5 <= row.pipeline_runtime_seconds < 120 and row.total_records == 3


def test_quoted_line_breaks(spark, tmp_path):
    from orgkin.sources import registry

    file = tmp_path / "extract.csv"
    file.write_text('LEI,Entity.LegalName\nL1,"Acme\nHolding"\nL2,Other\n')
    rows = registry.scan_registry_csv(spark, str(file)).collect()
    assert [tuple(r) for r in rows] == [("L1", "Acme\nHolding"), ("L2", "Other")]


def test_report_pages_agree(spark):
    from orgkin.operators import reports

    entities = spark.createDataFrame([("A", "Acme"), ("B", "Other")], "lei string, legal_name string")
    links = spark.range(200).selectExpr(
        "'A' AS key", "'OWNS' AS rel_type", "concat('T', id) AS target_label", "'' AS target_lei")
    issues = spark.createDataFrame([("A", "address is missing")], "lei string, issue string")
    lines = reports.report_lines(relationships=links, quality=issues)
    pages = reports.verification_reports(merge.entity_rows(entities, AS_OF).withColumn(
        "legal_address", F.from_json(F.lit("{}"), "line1 string, city string, postal string")
    ), lines, AS_OF, page_lines=50).collect()
    text = [p.report_text for p in pages if p.lei == "A"]
    assert len(text) > 1 and sum(t.count("- OWNS") for t in text) == 200
    assert sum("address is missing" in t for t in text) == 1
    denied = [t for t in text if "Data quality\nNone" in t]
    assert not denied and all("Watchlist hits\nNone identified" in t for t in text)
    assert [p.report_text.count("None identified") for p in pages if p.lei == "B"] == [4]
