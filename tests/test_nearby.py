"""Approximate neighbours and ranked countries against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgkin.functions.country import country_key, normalize_country
from orgkin.operators import countries, neighbours, vectors
from orgkin.refdata import iso_countries
from orgkin.sources import tables

POINT = "lei string, legal_name string, normalized_name string, country string, jurisdiction string, entity_status string, embedding array<float>"
SHAPE = neighbours.HashTables(32, floor=100, same=12)


def _points(spark, folder, rows):
    made = spark.createDataFrame([(i, i, i, c, c, s, v) for i, c, s, v in rows], POINT)
    return tables.write_stage(made.withColumn("norm", neighbours.cosine_raw("embedding", "embedding")), str(folder / "points"))


def _random_rows(n):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    mixed = centres[rng.integers(0, 40, n)] + 0.8 * rng.normal(size=(n, 32))
    return [
        (f"L{i:05d}", ("US", "DE", "FR", None)[i % 7 % 4], "ACTIVE" if i % 10 else "MERGED", [float(x) for x in v])
        for i, v in enumerate(mixed.astype(np.float32))
    ]


@pytest.fixture(scope="module")
def near_results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("near")
    rows = _random_rows(4000)
    points = _points(spark, folder, rows).withColumn("norm", F.lit(1.0)).withColumn(
        "norm", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    )
    asked = [(int(i), rows[i][3], (None, "us", "DE")[i % 3], "MERGED" if i % 3 == 2 else "") for i in range(0, 4000, 80)]
    queries = spark.createDataFrame(asked, "query_id int, vector array<float>, country string, entity_status string")
    hashed = tables.write_stage(neighbours.hash_rows(points, SHAPE), str(folder / "hashed"))
    return points, hashed, queries


def test_recall_and_candidates(near_results):
    points, hashed, queries = near_results
    exact = vectors.search_batch(points, queries, 10)
    found = neighbours.near(points, hashed, queries, SHAPE, 10)
    hits = {r.query_id: (r.wanted, r.found) for r in neighbours.recall(found, exact).collect()}
    met = dict(neighbours.candidates(hashed, vectors.asked_queries(queries), SHAPE).groupBy("query_id").count().collect())
    for kind, passing in ((0, 4000), (1, 1143), (2, 115)):
        mine = [q for q in hits if q % 3 == kind]
        assert sum(hits[q][1] for q in mine) >= 0.9 * sum(hits[q][0] for q in mine)
        if kind < 2:
            assert sum(met[q] for q in mine) < 0.5 * passing * len(mine)
    payload = found.join(queries.select("query_id", F.upper("country").alias("c")), "query_id").filter("c IS NOT NULL")
    assert payload.filter("country <> c OR country IS NULL").count() == 0
    # scores, names and order of what was found are those of the exact search
    same = found.select("query_id", "lei", "score").subtract(
        vectors.search_batch(points, queries, 4000).select("query_id", "lei", "score"))
    assert same.count() == 0


def test_buckets_are_signs_of_projections(near_results):
    points, hashed, _ = near_results
    planes = SHAPE.planes()
    rows = points.limit(20).collect()
    have = {(r.lei, r.bucket_table): r.bucket for r in hashed.collect()}
    for r in rows:
        bits = (planes @ np.array(r.embedding, dtype=float) > 0).reshape(SHAPE.tables, SHAPE.bits)
        for t in range(SHAPE.tables):
            assert have[r.lei, t] == sum(1 << b for b in range(SHAPE.bits) if bits[t, b])


def test_narrow_filters_and_awkward_vectors(spark, tmp_path):
    rng = random.Random(3)
    def vector():
        return [rng.gauss(0, 1) for _ in range(32)]
    rows = [(f"R{i:03d}", "US", "ACTIVE", vector()) for i in range(300)]
    rows += [("ONLY", "NA", "MERGED", vector()), ("NOWHERE", None, None, vector())]
    rows += [("NULL", "US", "ACTIVE", None), ("ZERO", "US", "ACTIVE", [0.0] * 32), ("SHORT", "US", "ACTIVE", [1.0] * 5)]
    rows += [("NAN", "US", "ACTIVE", [float("nan")] * 32), ("INF", "US", "ACTIVE", [float("inf")] * 32)]
    repeated = vector()
    rows += [(f"C{i:03d}", "US", "ACTIVE", repeated) for i in range(200)]
    points = _points(spark, tmp_path, rows).withColumn("norm", F.sqrt(F.aggregate(
        "embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))
    hashed = tables.write_stage(neighbours.hash_rows(points, SHAPE), str(tmp_path / "hashed"))
    assert not {"NULL", "ZERO", "SHORT", "NAN", "INF"} & {r.lei for r in hashed.select("lei").distinct().collect()}
    assert hashed.filter("lei LIKE 'C%'").select("lei").distinct().count() == SHAPE.same
    queries = spark.createDataFrame(
        [(1, repeated, None, None), (2, repeated, "na", None), (3, repeated, "XX", None), (4, None, None, None),
         (5, [0.0] * 32, None, None), (6, [1.0], None, None), (7, repeated, None, "merged")],
        "query_id int, vector array<double>, country string, entity_status string")
    got = {}
    for r in neighbours.near(points, hashed, queries, SHAPE, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.lei)
    assert got == {1: [f"C{i:03d}" for i in range(10)], 2: ["ONLY"], 7: ["ONLY"]}
    with pytest.raises(ValueError):
        neighbours.near(points, hashed, queries, SHAPE, 13)
    nothing = neighbours.hash_rows(points.limit(0), SHAPE)
    assert neighbours.near(points.limit(0), nothing, queries, SHAPE).count() == 0


def test_large_buckets_keep_exact_results(spark, tmp_path):
    """More bits than a query can reach: what it misses is searched exactly."""
    rng = random.Random(9)
    rows = [(f"R{i:03d}", "US", "ACTIVE", [rng.gauss(0, 1) for _ in range(32)]) for i in range(120)]
    points = _points(spark, tmp_path, rows).withColumn("norm", F.sqrt(F.aggregate(
        "embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))
    shape = neighbours.HashTables(32, tables=2, bits=24, agree=2)
    hashed = neighbours.hash_rows(points, shape)
    queries = spark.createDataFrame([(i, rows[i][3]) for i in range(4)], "query_id int, vector array<double>")
    got = neighbours.near(points, hashed, queries, shape, 10)
    assert got.orderBy("query_id", "rank").collect() == vectors.search_batch(points, queries, 10).select(got.columns).orderBy(
        "query_id", "rank").collect()


def _triples(key):
    padded = f"  {key} "
    return {padded[i: i + 3] for i in range(len(key) + 1)}


def test_ranking_against_brute_force(spark):
    names = [("US", "United States"), ("GB", "United Kingdom"), ("AE", "United Arab Emirates"), ("NE", "Niger"), ("NG", "Nigeria"),
             ("XA", "Same Name"), ("XB", "Same Name"), (None, "Nowhere")]
    texts = ["Untied States", "Unitd Kingdm", "Nigerai", "NIGERIA", "same  name", "q", "", None, "12", "é", "Nigerai"]
    got = countries.ranked_countries(
        spark.createDataFrame([(t,) for t in texts], "said string"), "said", 3, spark.createDataFrame(names, "code string, name string"))
    want = []
    for text in sorted({t for t in texts if t}):
        key = " ".join(text.upper().replace("É", "E").split())
        if not key.isascii() or not key.replace(" ", "").isalpha():
            continue
        scores = {}
        for code, name in names[:-1]:
            a, b = _triples(key), _triples(name.upper())
            if a & b:
                scores[code] = max(scores.get(code, 0), 2 * len(a & b) / (len(a) + len(b)))
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
        want += [(text, i + 1, c, pytest.approx(s)) for i, (c, s) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_misspelt_iso_names(spark):
    """Thirty long names with two neighbouring letters exchanged, one left out, one doubled."""
    long_names = [(two, name) for two, _, name in iso_countries() if len(name) > 7 and name.isascii() and name.isalpha()][:30]
    rows = []
    for two, name in long_names:
        rows += [(two, name[:3] + name[4] + name[3] + name[5:]), (two, name[:4] + name[5:]), (two, name[:5] + name[4:])]
    rows += [("DE", "germany"), ("DE", "DEU"), ("de", " de "), ("ZZ", "zzz unknown"), (None, None)]
    df = spark.createDataFrame(rows, "want string, said string")
    got = countries.resolve_countries(df, "said", "code").collect()
    assert len(got) == len(rows)
    wrong = [r for r in got if r.want and r.code != r.want.upper()]
    assert not wrong
    assert [r.code for r in got if r.want is None] == [""]
    assert df.select(normalize_country("said")).count() == len(rows)
    assert countries.resolve_countries(df.limit(0), "said", "code").count() == 0
    keys = df.select(country_key(F.lit("The  Côte d’Ivoire"))).first()[0]
    assert keys == "COTE DIVOIRE"


def test_too_many_names(spark):
    many = spark.range(countries.MOST_NAMES + 1).select(F.lit("XX").alias("code"), F.col("id").cast("string").alias("name"))
    with pytest.raises(ValueError):
        countries.ranked_countries(many, "name", names=many)
