"""One Spark query per operator, each over whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views as V
from orgkin import schemas
from orgkin.functions import profile as P
from orgkin.functions import scoring as S
from orgkin.functions import text as X
from orgkin.functions.country import normalize_country
from orgkin.functions.numeric import percent, round_exact
from orgkin.operators import (
    graph, keyed, merge, quality, reports, resolve, review, search, vectors,
)
from orgkin.operators.clean import clean_columns, clean_entities, stage_boundary
from orgkin.refdata import DUPLICATE_SAMPLE, ENTITY_STATUSES, REGISTRATION_STATUSES, REVIEW
from orgkin.session import scratch_dir
from orgkin.sources import registry, tables, watchlist

AS_OF = dt.datetime(2024, 6, 1)
EARLIER = dt.datetime(2024, 5, 1)
PROBE_KEY = "LEI" + "7".rjust(17, "0")


# --- shared inputs --------------------------------------------------------------------
def raw(spark, sf):
    """All filings; the small test files arrive as one task, so the narrow orders are dealt out."""
    return V.spark_view(spark, sf, V.RAW, orders=keyed.spread(V.table(spark, sf, "orders"), "o_orderkey"))


_STAGES: dict[tuple, DataFrame] = {}


def staged(spark, sf, name: str, build) -> DataFrame:
    """What several queries share, written once per session as the batch run does."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGES:
        _STAGES[key] = tables.write_stage(build(spark, sf), scratch_dir(spark, name))
    return _STAGES[key]


def clean_lazy(spark, sf):
    return stage_boundary(clean_entities(raw(spark, sf)))


def duplicates_lazy(spark, sf):
    copies = resolve.labelled_duplicates(raw(spark, sf), None, first_by="ingest_ord")
    return stage_boundary(clean_entities(copies))


def clean(spark, sf):
    return staged(spark, sf, "clean", lambda s, d: stage_boundary(clean_entities(raw(s, d), reread=True)))


def duplicates(spark, sf):
    return staged(spark, sf, "duplicates", duplicates_lazy)


def noisy_filings(spark, sf):
    """Every filing's noisy copy, cleaned but not reduced to one per key."""
    return stage_boundary(clean_columns(resolve.labelled_duplicates(raw(spark, sf), None)))


def vector_table(spark, sf):
    return V.spark_view(spark, sf, V.VECTORS)


def matches_lazy(spark, sf):
    return resolve.resolve(
        clean_lazy(spark, sf), duplicates_lazy(spark, sf), vector_table(spark, sf), AS_OF
    )


def matches(spark, sf):
    return staged(spark, sf, "matches", matches_lazy)


def stored(spark, sf):
    return merge.entity_rows(clean(spark, sf), AS_OF)


def index(spark, sf):
    return vectors.index_rows(clean(spark, sf), vector_table(spark, sf))


def nodes_lazy(spark, sf):
    """Real and marked companies, with the codes of the real ones."""
    real = graph.entity_nodes(clean(spark, sf))
    return real.unionByName(graph.company_nodes(duplicates(spark, sf)))


def nodes(spark, sf):
    return staged(spark, sf, "nodes", nodes_lazy)


def edges_lazy(spark, sf):
    n = nodes(spark, sf)
    owned = tables.relationships(spark, V.spark_view(spark, sf, V.RELATIONSHIPS))
    return (
        graph.entity_edges(clean(spark, sf))
        .unionByName(graph.match_edges(matches(spark, sf), n))
        .unionByName(graph.ownership_edges(owned, n))
    )


def edges(spark, sf):
    return staged(spark, sf, "edges", edges_lazy)


def runs(spark, sf):
    day = V.spark_view(spark, sf, V.QUALITY_RUNS)
    score = round_exact(F.col("valid_records") / F.col("total_records") * 100, 2)
    return schemas.conform(
        day.withColumns({"data_quality_score": score, "id": F.col("run_date").cast("string")}),
        schemas.QUALITY_RUNS,
    )


def reviews(spark, sf):
    """Reviewer log over match ids."""
    ids = S.match_id("lei", F.concat(F.lit("SYNTH_"), F.col("lei")))
    return V.spark_view(spark, sf, V.REVIEW_EVENTS).select(
        ids.alias("match_id"), "decision", "ts", "seq"
    )


def _codes(df: DataFrame) -> DataFrame:
    """Array of codes as text, for comparison."""
    return df.withColumn("reason_codes", F.array_join("reason_codes", ","))


def _addresses(df: DataFrame) -> DataFrame:
    have = [c for c in ("legal_address", "headquarters_address") if c in df.columns]
    return df.withColumns({c: P.address_json(c) for c in have})


# --- sources ----------------------------------------------------------------------------
def src_a1_registry_csv(spark, sf):
    """Write filings in the registry's own column names, then scan and map them back."""
    path = scratch_dir(spark, "registry")
    names = {t: s for s, t in registry.R.REGISTRY_COLUMNS.items()}
    rows = raw(spark, sf)
    out = rows.select(*[F.col(c).alias(names[c]) for c in names], F.lit("x").alias("Other.Column"))
    out.write.csv(path, header=True, escape='"', compression="gzip",
                  ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return stage_boundary(registry.read_registry(spark, path, None)).select(
        "lei", "legal_name", "country", "jurisdiction", "legal_address_line1",
        "initial_registration_date", "managing_lou",
    )


def src_a3_sample(spark, sf):
    return keyed.exact_sample(raw(spark, sf), 5000, 42, ["lei", "ingest_ord"]).select(
        "lei", "ingest_ord"
    )


def src_a5_watchlist(spark, sf):
    lines = V.spark_view(spark, sf, V.WATCHLIST_LINES)
    return watchlist.watchlist_rows(watchlist.parse_lines(lines))


def src_a6_first_rows(spark, sf):
    """The scan with a cap: the first 40 organisations in key order."""
    lines = V.spark_view(spark, sf, V.WATCHLIST_LINES)
    return watchlist.watchlist_rows(watchlist.parse_lines(lines), 40)


def src_a8_reused_extract(spark, sf):
    """An extract that is built once and then read, even if it would be built otherwise."""
    path = f"{scratch_dir(spark, 'extract')}/rows"
    rows = raw(spark, sf).select("lei", "ingest_ord")
    tables.read_or_build(spark, path, lambda: rows)
    return tables.read_or_build(spark, path, lambda: rows.limit(0))


def src_a7_corrupt_lines(spark, sf):
    lines = V.spark_view(spark, sf, V.WATCHLIST_LINES)
    return watchlist.corrupt_lines(watchlist.parse_lines(lines))


# --- normalisation -----------------------------------------------------------------------
def norm_c1_company_name(spark, sf):
    return raw(spark, sf).select("ingest_ord", X.normalize_name("legal_name").alias("name"))


def norm_c2_ascii_fold(spark, sf):
    docs = V.table(spark, sf, "documents")
    return docs.select("doc_id", X.ascii_fold("text").alias("folded"))


def norm_c3_title_case(spark, sf):
    docs = V.table(spark, sf, "documents")
    return docs.select("doc_id", X.title_case("text").alias("titled"))


def norm_c4_strict_suffixes(spark, sf):
    return raw(spark, sf).select("ingest_ord", X.normalize_name("legal_name", True).alias("name"))


def norm_c5_collapse_spaces(spark, sf):
    docs = V.table(spark, sf, "documents")
    return docs.select("doc_id", X.collapse_spaces("text").alias("collapsed"))


def norm_c6_drop_dots(spark, sf):
    return raw(spark, sf).select("ingest_ord", X.drop_dots("legal_name").alias("name"))


def norm_c7_address(spark, sf):
    return raw(spark, sf).select(
        "ingest_ord", X.normalize_address("legal_address_line1").alias("legal"),
        X.normalize_address("hq_address_line1").alias("hq"),
    )


def norm_c8_country(spark, sf):
    return raw(spark, sf).select(
        "ingest_ord", normalize_country("country").alias("country"),
        normalize_country("hq_country").alias("hq_country"),
    )


def norm_c9_status(spark, sf):
    return raw(spark, sf).select(
        "ingest_ord", X.standardize_status("entity_status", ENTITY_STATUSES).alias("entity"),
        X.standardize_status("registration_status", REGISTRATION_STATUSES).alias("registration"),
    )


def norm_c10_clean_entities(spark, sf):
    return clean_lazy(spark, sf).drop("other_names")


def norm_c11_text_profile(spark, sf):
    return clean(spark, sf).select("lei", "ingest_ord", P.text_profile().alias("profile"))


def norm_c12_address_json(spark, sf):
    packed = clean(spark, sf).select(
        "ingest_ord", P.address_json(P.pack_legal_address()).alias("legal_address")
    )
    return packed.withColumn("shown", P.address_display("legal_address"))


def norm_c14_reason_codes(spark, sf):
    text = matches(spark, sf).select("id", F.to_json("reason_codes").alias("codes"))
    return text.select(
        "id", "codes", F.size(P.parse_codes("codes")).alias("n_codes"),
        F.array_join(P.parse_codes("codes"), "|").alias("joined"),
    )


def norm_c16_percent(spark, sf):
    return matches(spark, sf).select("id", percent("final_score").alias("percent"))


# --- quality ----------------------------------------------------------------------------
def dq_g1_metrics(spark, sf):
    """Metrics and checks over every filing, repeats included."""
    rows = stage_boundary(clean_columns(raw(spark, sf)))
    return quality.flat_checks(quality.quality_metrics(rows)).drop(
        "run_date", "pipeline_runtime_seconds"
    )


def dq_g1_metrics_clean(spark, sf):
    return quality.flat_checks(quality.quality_metrics(clean(spark, sf))).drop(
        "run_date", "pipeline_runtime_seconds"
    )


def dq_d14_issues(spark, sf):
    return quality.quality_issues(clean(spark, sf))


# --- sinks ------------------------------------------------------------------------------
def sink_b1_stage_roundtrip(spark, sf):
    path = scratch_dir(spark, "stage")
    watched, seen = tables.counted(clean_entities(raw(spark, sf)), "clean")
    back = tables.write_stage(watched, path)
    return back.groupBy("country").agg(
        F.count(F.lit(1)).alias("entities"), F.count("legal_name").alias("named"),
        F.lit(seen.get["rows"]).alias("rows_written"),
    )


def sink_b3_vectors_roundtrip(spark, sf):
    path = scratch_dir(spark, "vectors")
    tables.write_vectors(vector_table(spark, sf), path)
    back = tables.read_vectors(spark, path)
    return back.select(
        "lei", F.size("embedding").alias("dims"), F.round(S.norm("embedding"), 4).alias("norm")
    )


def _upsert_inputs(spark, sf):
    before = clean(spark, sf)
    ordered = V.table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(
        F.format_string("LEI%017d", "o_custkey").alias("lei")
    )
    renamed = before.join(ordered, "lei", "left_semi").withColumns(
        {
            "legal_name": F.concat(F.coalesce("legal_name", F.lit("")), F.lit(" Renewed")),
            "country": F.lit("ZZ"), "entity_status": F.lit("INACTIVE"),
        }
    )
    fresh = clean_columns(V.spark_view(spark, sf, V.SUPPLIER_RAW))
    return merge.entity_rows(before, EARLIER), renamed.unionByName(
        stage_boundary(fresh), allowMissingColumns=True
    )


def sink_b4_upsert_entities(spark, sf):
    before, load = _upsert_inputs(spark, sf)
    return _addresses(merge.upsert_entities(before, load, AS_OF, small_source=False))


def sink_b4_upsert_small_load(spark, sf):
    before, load = _upsert_inputs(spark, sf)
    return _addresses(merge.upsert_entities(before, load, AS_OF, small_source=True))


def sink_b4_upsert_repeated_keys(spark, sf):
    """Every filing upserted in order: first one inserts, later ones update."""
    update = ("legal_name", "legal_address_line1", "entity_status")
    rows = clean_columns(raw(spark, sf)).select(
        "lei", "ingest_ord", "country", "jurisdiction", *update
    ).filter(merge.real_key())
    return merge.fold_source(rows, "lei", update, "ingest_ord")


def sink_b5_new_matches(spark, sf):
    """Matches not stored yet, when those a reviewer saw are."""
    found = matches(spark, sf)
    known = reviews(spark, sf).filter("decision = 'accepted'").select(
        F.col("match_id").alias("id")
    ).distinct()
    return merge.new_rows(known, found).select("id", "lei_a", "lei_b", "final_score", "decision")


def sink_b6_quality_run(spark, sf):
    run = tables.quality_run_row(quality.quality_metrics(clean(spark, sf), AS_OF))
    return run.drop("id", "pipeline_runtime_seconds")


def sink_b8_graph_nodes(spark, sf):
    return graph.entity_nodes(raw(spark, sf), "ingest_ord")


def sink_b8_graph_edges(spark, sf):
    return graph.entity_edges(stage_boundary(clean_columns(raw(spark, sf))))


def sink_b9_match_edges(spark, sf):
    return graph.match_edges(matches(spark, sf), nodes(spark, sf))


def sink_b10_ownership_edges(spark, sf):
    owned = tables.relationships(spark, V.spark_view(spark, sf, V.RELATIONSHIPS))
    return graph.ownership_edges(owned, graph.entity_nodes(clean(spark, sf)))


def sink_b11_vector_index(spark, sf):
    """Index of renamed entities merged over the index of the earlier load."""
    load = clean(spark, sf).filter("country = 'DE'").withColumn("legal_name", F.lit("Renamed"))
    merged = vectors.upsert_index(index(spark, sf), load, vector_table(spark, sf))
    return merged.drop("embedding").withColumn("norm", F.round("norm", 4))


# --- resolution --------------------------------------------------------------------------
def er_j12_labelled_duplicates(spark, sf):
    return resolve.labelled_duplicates(raw(spark, sf), None).select(
        "ingest_ord", "lei", "origin_lei", "legal_name", "source"
    )


def er_j12_sampled_duplicates(spark, sf):
    return resolve.labelled_duplicates(raw(spark, sf), DUPLICATE_SAMPLE).select("ingest_ord", "lei", "legal_name")


def er_e1_pair_join(spark, sf):
    pairs = resolve.pair_rows(clean(spark, sf), noisy_filings(spark, sf))
    return pairs.select(
        "ingest_ord", F.col("a_lei").alias("lei_a"), F.col("b_lei").alias("lei_b"),
        F.col("a_normalized_name").alias("name_a"), F.col("b_normalized_name").alias("name_b"),
    )


def er_e1_last_duplicate_wins(spark, sf):
    """Raw real rows repeat their key: the last one is the partner."""
    pairs = resolve.pair_rows(raw(spark, sf), duplicates(spark, sf), last_by="ingest_ord")
    return pairs.select(
        F.col("a_lei").alias("lei_a"), F.col("b_lei").alias("lei_b"),
        F.col("a_legal_name").alias("name_a"),
    )


def er_j1_name_similarity(spark, sf):
    pairs = resolve.pair_rows(clean(spark, sf), noisy_filings(spark, sf))
    return S.with_signals(pairs, name=("a_normalized_name", "b_normalized_name")).select(
        "ingest_ord", F.col("b_lei").alias("lei_b"), "name_similarity"
    )


def er_j2_address_similarity(spark, sf):
    pairs = resolve.pair_rows(clean(spark, sf), noisy_filings(spark, sf))
    text = pairs.withColumns(
        {f"addr_{s}": S.address_text(f"{s}_legal_address_line1", f"{s}_legal_address_city")
         for s in ("a", "b")}
    )
    return S.with_signals(text, address=("addr_a", "addr_b")).select(
        "ingest_ord", F.col("b_lei").alias("lei_b"), "addr_a", "addr_b", "address_similarity"
    )


def er_j6_vector_similarity(spark, sf):
    v = vector_table(spark, sf)
    real = v.filter(F.startswith("lei", F.lit("LEI"))).select("lei", F.col("embedding").alias("a"))
    marked = v.filter(F.startswith("lei", F.lit("SYNTH_"))).select(
        F.replace("lei", F.lit("SYNTH_"), F.lit("")).alias("lei"), F.col("embedding").alias("b")
    )
    pairs = real.join(marked, "lei", "left")
    return S.with_signals(pairs, vector=("a", "b")).select("lei", "embedding_similarity")


def er_j11_resolve(spark, sf):
    return _codes(matches_lazy(spark, sf))


def er_j11_resolve_filings(spark, sf):
    """Every noisy filing against its record: many rows per key, no vectors."""
    pairs = resolve.pair_rows(clean(spark, sf), noisy_filings(spark, sf))
    return resolve.score_pairs(pairs).groupBy("decision").agg(
        F.count(F.lit(1)).alias("pairs"), F.min("final_score").alias("lowest"),
        F.max("final_score").alias("highest"),
    )


def er_s1_renormalised(spark, sf):
    found = resolve.resolve(clean(spark, sf), duplicates(spark, sf), None,
                            renormalise_missing=True)
    return found.select("id", "final_score", "decision")


def er_e3_compare(spark, sf):
    """Each company against the parent it reports."""
    asked = V.spark_view(spark, sf, V.RELATIONSHIPS).select(
        F.col("lei").alias("lei_a"), F.col("parent_lei").alias("lei_b")
    )
    return _codes(resolve.compare(asked, stored(spark, sf))).drop("created_at")


def er_e3_unknown_keys(spark, sf):
    asked = V.spark_view(spark, sf, V.RELATIONSHIPS).select(
        F.col("lei").alias("lei_a"), F.col("parent_lei").alias("lei_b")
    )
    return resolve.unknown_keys(asked, stored(spark, sf))


# --- search and pages ---------------------------------------------------------------------
def search_h1_page(spark, sf):
    return _addresses(search.search_entities(
        stored(spark, sf), query="north h%r", jurisdiction="nation_", entity_status="active",
        limit=50, offset=3,
    ))


def search_d3_country(spark, sf):
    return _addresses(search.search_entities(stored(spark, sf), country="de", limit=100))


def search_d6_lookup(spark, sf):
    return _addresses(search.entity_by_lei(stored(spark, sf), PROBE_KEY))


def search_h2_match_page(spark, sf):
    return _codes(search.match_page(matches(spark, sf), REVIEW, limit=200, offset=5))


def search_h3_duplicates(spark, sf):
    return _codes(search.duplicates_of(matches(spark, sf), PROBE_KEY))


def search_h3_duplicates_batch(spark, sf):
    return search.duplicates_per_entity(matches(spark, sf)).select(
        "lei", F.col("rank").cast("long").alias("rank"), "id", "final_score"
    )


def search_h4_latest_run(spark, sf):
    return search.latest_run(runs(spark, sf)).select(
        "run_date", "total_records", "valid_records", "data_quality_score"
    )


def search_g4_dashboard(spark, sf):
    return search.dashboard_stats(
        stored(spark, sf), matches(spark, sf), runs(spark, sf), index(spark, sf)
    )


def search_g5_vector_count(spark, sf):
    return search.vector_count(index(spark, sf))


# --- vectors -----------------------------------------------------------------------------
def vec_k1_embed(spark, sf):
    rows = clean(spark, sf)
    return vectors.embed(rows, vectors.fit_embedder(rows, 256))


def vec_k1_embed_quality(spark, sf):
    """Vectors have unit length and one dimension; counts are what SQL can check."""
    rows = clean(spark, sf)
    made = vectors.embed(rows, vectors.fit_embedder(rows, 256))
    return made.agg(
        F.count(F.lit(1)).alias("vectors"), F.count_distinct("lei").alias("keys"),
        F.max(F.size("embedding")).alias("dims"),
        F.round(F.min(S.norm("embedding")), 4).alias("shortest"),
        F.round(F.max(S.norm("embedding")), 4).alias("longest"),
    )


def _centroids(spark, sf) -> DataFrame:
    """One query per label: the mean of its vectors, with a country to search in."""
    parts = V.table(spark, sf, "embeddings").select("label", F.posexplode("embedding"))
    mean = parts.groupBy("label", "pos").agg(F.avg(F.col("col").cast("double")).alias("v"))
    sorted_values = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda r: r["v"]
    )
    return mean.groupBy("label").agg(sorted_values.alias("vector")).withColumnRenamed(
        "label", "query_id"
    )


def vec_k2_topk(spark, sf):
    """One query with a payload filter: the mean of all vectors."""
    parts = V.table(spark, sf, "embeddings").select(F.posexplode("embedding"))
    mean = parts.groupBy("pos").agg(F.avg(F.col("col").cast("double")).alias("v"))
    vector = [r.v for r in mean.orderBy("pos").collect()]
    return vectors.semantic_search(index(spark, sf), vector, 10, entity_status="active")


def vec_k2_topk_batch(spark, sf):
    """Every stored vector as a query against the whole index."""
    queries = V.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")
    )
    found = vectors.search_batch(index(spark, sf), queries, 5)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "lei", "score")


def vec_k2_topk_grid(spark, sf):
    """The same search when the queries are too many to send to every task."""
    queries = V.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")
    )
    found = vectors.search_batch(index(spark, sf), queries, 5, max_queries=100)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "lei", "score")


def vec_k4_text_search(spark, sf):
    """Search texts become vectors by the model of the index, and find their nearest companies."""
    rows = clean(spark, sf)
    model = vectors.fit_embedder(rows, 256)
    asked = vectors.embed_text(V.spark_view(spark, sf, V.SEARCH_TEXT), model, F.col("text"), "vector")
    found = vectors.search_batch(
        vectors.index_rows(rows, vectors.embed(rows, model)), asked.select("query_id", "vector"), 5
    )
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "lei", "score")


def vec_k3_parsed_filters(spark, sf):
    """Label centroids with parsed filters: explicit country beats the parsed one."""
    queries = _centroids(spark, sf).withColumns(
        {
            "country": F.when(F.col("query_id") % 2 == 0, F.lit("de")),
            "parsed_country": F.lit("FR"),
            "parsed_entity_status": F.when(F.col("query_id") % 3 == 0, F.lit("ACTIVE")),
        }
    )
    found = vectors.search_batch(index(spark, sf), queries, 3)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "lei", "legal_name", "country",
        "entity_status", "score",
    )


# --- graph ------------------------------------------------------------------------------
def graph_l1_nodes(spark, sf):
    return graph.neighbourhood_nodes(nodes(spark, sf), edges(spark, sf))


def graph_l1_edges(spark, sf):
    return graph.neighbourhood_edges(edges(spark, sf))


def graph_l1_one_entity(spark, sf):
    keys = spark.createDataFrame([(PROBE_KEY,), ("MISSING",)], "key string")
    return graph.neighbourhood_nodes(nodes(spark, sf), edges(spark, sf), keys)


def graph_l2_relationships(spark, sf):
    return graph.relationship_list(nodes(spark, sf), edges(spark, sf))


# --- review -----------------------------------------------------------------------------
def review_n1_with_reviews(spark, sf):
    return review.with_reviews(matches(spark, sf), reviews(spark, sf)).select(
        "id", "decision", "reviewer_decision", "reviewed_at"
    )


def review_n1_unknown(spark, sf):
    return review.unknown_reviews(matches(spark, sf), reviews(spark, sf)).select(
        "id", "reviewer_decision"
    )


def review_n2_queue(spark, sf):
    return review.review_queue(matches(spark, sf), reviews(spark, sf), limit=200).select(
        "id", "final_score", "reviewer_decision", "reviewed_at"
    )


def review_g10_counts(spark, sf):
    return review.review_counts(review.with_reviews(matches(spark, sf), reviews(spark, sf)))


# --- reports ----------------------------------------------------------------------------
def report_m1_explanations(spark, sf):
    return reports.explain_matches(matches(spark, sf))


def _report_lines(spark, sf):
    rows = clean(spark, sf)
    return reports.report_lines(
        duplicates=search.duplicates_per_entity(matches(spark, sf)),
        relationships=graph.relationship_list(nodes(spark, sf), edges(spark, sf)),
        quality=quality.quality_issues(rows),
    )


def report_m2_verification(spark, sf):
    made = reports.verification_reports(stored(spark, sf), _report_lines(spark, sf), AS_OF)
    return made.select("lei", "page", "report_text")


def report_b12_append(spark, sf):
    """Two appends of all reports to one table, read back as counts."""
    path = scratch_dir(spark, "reports")
    made = reports.verification_reports(
        stored(spark, sf), reports.report_lines(quality=quality.quality_issues(clean(spark, sf))),
        AS_OF,
    )
    made.write.mode("append").parquet(path)
    made.write.mode("append").parquet(path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
        F.count_distinct("lei").alias("entities"),
    )


def report_m3_parsed_queries(spark, sf):
    return reports.parse_queries(V.spark_view(spark, sf, V.SEARCH_TEXT))


PREFIXES = ("src_", "norm_", "dq_", "sink_", "er_", "search_", "vec_", "graph_", "review_",
            "report_")


def all_queries():
    from checks.linkage import linkage_queries
    from checks.nearby import nearby_queries

    own = {n: f for n, f in globals().items() if n.startswith(PREFIXES) and callable(f)}
    return own | linkage_queries() | nearby_queries()
