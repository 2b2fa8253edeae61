"""Precision-recall figures and shared addresses against brute force."""

import collections
import hashlib
import itertools
import random

from pyspark.sql import functions as F

from orgkin.operators import addresses, benchmark

PAIR = "noise string, decision string, final_score double, truth boolean, step string"


def _scored(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["typo", "case"]), rng.choice(["SAME", "OTHER"]), rng.randrange(0, 10_001) / 10_000,
         rng.choice([True, False, None]), "x")
        for _ in range(300)
    ]
    rows += [("typo", "SAME", s, t, "x") for s in (0.0, 0.29, 0.57, 0.58, 1.0, None) for t in (True, False)]
    rows += [("missed", "OTHER", None, True, "x"), ("missed", "OTHER", float("nan"), True, "x"),
             ("none", "OTHER", 0.5, None, "x")]
    return rows, spark.createDataFrame(rows, PAIR)


def _at_line(rows, line):
    """Counts by looking at every pair; ``line`` in hundredths."""
    found = [r for r in rows if r[2] is not None and round(r[2] * 10_000) >= line * 100] if rows else []
    tp = sum(r[3] is True for r in found)
    return tp, len(found) - tp, sum(r[3] is True for r in rows) - tp


def test_curve_counts_every_pair(spark):
    rows, df = _scored(spark, 1)
    hist = benchmark.score_histogram(df, F.col("truth"), ["noise"]).cache()
    for by, groups in ((["noise"], {r[0] for r in rows}), ([], {None})):
        got = benchmark.precision_recall(hist, by).collect()
        assert len(got) > 50
        assert "missed" not in {r.noise for r in got} if by else True
        for r in got:
            mine = [x for x in rows if not by or x[0] == r.noise]
            mine = [(*x[:2], None if x[2] is not None and x[2] != x[2] else x[2], x[3]) for x in mine]
            tp, fp, fn = _at_line(mine, round(r.threshold * 100))
            assert (r.tp, r.fp, r.fn) == (tp, fp, fn)
            assert r.precision == tp / (tp + fp)
            assert r.recall == (tp / (tp + fn) if tp + fn else None)
        assert not by or {r.noise for r in got} == groups - {"missed"}


def test_best_line_and_decisions(spark):
    rows, df = _scored(spark, 2)
    hist = benchmark.score_histogram(df, F.col("truth"), ["noise"])
    curve = benchmark.precision_recall(hist, ["noise"])
    points = curve.collect()
    for r in benchmark.best_lines(curve, ["noise"]).collect():
        assert (r.f1, r.threshold) == max((p.f1, p.threshold) for p in points if p.noise == r.noise)
    want = collections.Counter((r[0], r[1], r[3] is True) for r in rows)
    for r in benchmark.by_decision(hist, ["noise"]).collect():
        assert (r.matches, r.others) == (want[r.noise, r.decision, True], want[r.noise, r.decision, False])
        assert r.precision == r.matches / (r.matches + r.others)


def test_no_pairs_no_curve(spark):
    hist = benchmark.score_histogram(spark.createDataFrame([], PAIR), F.col("truth"))
    assert benchmark.precision_recall(hist).count() == 0
    assert benchmark.best_lines(benchmark.precision_recall(hist)).count() == 0
    assert benchmark.by_decision(hist).count() == 0


ENTITY = (
    "lei string, legal_address_line1 string, legal_address_city string, country string, "
    "hq_address_line1 string, hq_address_city string, hq_country string, address_id string, label string"
)


def _entities():
    """A hub of a third of all companies, small groups, and rows with nothing to share."""
    rows = [(f"h{i:02}", "1 Hub  St.", "Wilmington", "US", f"{i % 9} Back Rd", "Lyon", "FR") for i in range(20)]
    rows += [(f"s{i:02}", f"{i // 3} Rue de l'Église", "Lyon", "FR", "1 HUB ST", "wilmington" if i == 0 else None, "us")
             for i in range(12)]
    rows += [("a", None, "Lyon", "FR", "", "Lyon", "FR"), ("b", "東京", None, None, "  ", None, None),
             ("c", "7 " + "long " * 5_000, "", None, "7 " + "long " * 5_000, None, None),
             (None, "1 Hub St", "Wilmington", "US", None, None, None)]
    return [(*r, "clash", "clash") for r in [*rows, rows[0]]]


def _text(*parts):
    import re
    import unicodedata

    if not (parts[0] or "").strip():
        return None
    said = unicodedata.normalize("NFKD", " ".join(p for p in parts if p is not None))
    return re.sub("[^A-Z0-9]+", " ", said.encode("ascii", "ignore").decode().upper()).strip() or None


def _places(rows):
    out = set()
    for r in rows:
        for kind, parts in (("LEGAL_ADDRESS", r[1:4]), ("HEADQUARTERS_ADDRESS", r[4:7])):
            if r[0] is not None and _text(*parts):
                out.add((r[0], kind, _text(*parts)))
    return out


def test_nodes_and_edges(spark):
    rows = _entities()
    df = spark.createDataFrame(rows, ENTITY)
    places, digest = _places(rows), lambda t: hashlib.sha256(t.encode()).hexdigest()
    nodes = [(r.node_type, r.id, r.label) for r in addresses.address_nodes(df).collect()]
    assert sorted(nodes) == sorted({("Address", digest(t), t) for _, _, t in places})
    edges = [(r.src, r.edge_type, r.dst) for r in addresses.address_edges(df).collect()]
    assert sorted(edges) == sorted((lei, kind, digest(t)) for lei, kind, t in places)
    assert addresses.address_nodes(df.limit(0)).count() == 0
    assert addresses.address_edges(df.select("lei")).count() == 0


def test_pairs_and_hub_rows_hold_every_link(spark):
    rows = _entities()
    members = addresses.address_members(spark.createDataFrame(rows, ENTITY)).cache()
    at = collections.defaultdict(set)
    for lei, _, text in _places(rows):
        at[text].add(lei)
    hub = 4
    want = collections.Counter(
        p for who in at.values() if len(who) <= hub for p in itertools.combinations(sorted(who), 2)
    )
    got = {(r.lei_a, r.lei_b): r.addresses for r in addresses.co_located(members, hub).collect()}
    assert got == dict(want) and got
    held = collections.defaultdict(set)
    for r in addresses.hub_members(members, hub).collect():
        held[r.address_id].add(r.lei)
        assert r.companies in (21, 11)
    assert sorted(map(sorted, held.values())) == sorted(sorted(who) for who in at.values() if len(who) > hub)
    shares = {r.lei: (r.addresses, r.hubs, r.others) for r in addresses.sharing(members, hub).collect()}
    for lei, figures in shares.items():
        mine = [who for who in at.values() if lei in who]
        assert figures == (len(mine), sum(len(w) > hub for w in mine), sum(len(w) - 1 for w in mine))
    assert "a" not in shares and "b" not in shares and None not in shares
