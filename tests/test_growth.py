"""Work that grows with the input: what is met, measured, held and shuffled."""

import random

from orgkin.functions import scoring
from orgkin.operators import blocking, screening


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _brute(spark, left, right, line):
    words = {r.name: set(r.w) for r in _names(spark, left | right).select("name", blocking.name_words("name").alias("w")).collect()}
    near = [(a, b) for a in left for b in right
            if words[a] & words[b] and 2 * len(words[a] & words[b]) >= min(len(words[a]), len(words[b]))]
    scored = scoring.with_signals(spark.createDataFrame(near, "a string, b string"), name=("a", "b"))
    return {tuple(r) for r in scored.filter(f"name_similarity >= {line}").select("a", "b", "name_similarity").collect()}


def test_a_word_that_all_names_have_brings_no_names_together(spark):
    left = _names(spark, {f"Common Left{i} Own{i}" for i in range(150)} | {"Common Shared Thing"})
    right = _names(spark, {f"Common Right{i} Part{i}" for i in range(150)} | {"Common Shared Thing Else"})
    rows = {
        side: df.select(F_name(side), blocking.name_words("name").alias(f"{side}_words"))
        for side, df in (("s", left), ("l", right))
    }
    assert screening._meetings(rows["s"], rows["l"]).count() < 10
    assert [(r.a, r.b) for r in screening.similar_names(left, right, 0.7).collect()] == [("Common Shared Thing", "Common Shared Thing Else")]


def F_name(side):
    from pyspark.sql import functions as F

    return F.col("name").alias(f"{side}_name")


def test_names_of_any_length_are_met_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(screening, "CELL", 3)  # every frequent key is a grid
    draw = random.Random(5)
    pool = [f"word{c}" for c in "abcdefgh"]
    long = [f"rare{i:02d}" for i in range(20)]

    def names(n):
        out = {" ".join(draw.choices(pool, k=draw.randint(1, 6))) for _ in range(n)}
        return out | {" ".join(draw.sample(long, draw.randint(8, 18))) for _ in range(n // 3)} | {"Inc", "Co Ltd"}

    left, right = names(60), names(60)
    got = [tuple(r) for r in screening.similar_names(_names(spark, left), _names(spark, right), 0.7).collect()]
    assert len(got) == len(set(got)) > 50
    # length_ratio(0.7) bounds no pair that scores 0.7
    assert set(got) == _brute(spark, left, right, 0.7)


def test_a_line_on_a_similarity_does_not_repeat_the_alignment(spark, plan):
    rows = spark.createDataFrame([("a b", "a c"), ("x", "y")], "a string, b string")
    scored = scoring.with_signals(rows, name=("a", "b"), address=("a", "b"))
    text = plan(scored.filter("name_similarity >= 0.5 AND address_similarity >= 0.5"))
    assert text.split("Initial Plan")[0].count("ArrowEvalPython") == 1


def test_scores_are_held_in_bounded_pieces(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from orgkin.operators import vectors

    draw = np.random.default_rng(3)
    asked, mine = draw.normal(size=(2000, 8)), draw.normal(size=(10_000, 8)).astype(np.float32)
    mine[5_000:] = mine[:5_000]  # every point twice: equal scores are ranked by key
    keys = [f"K{i:05d}" for i in draw.permutation(len(mine))]
    same = pa.array(["x"] * len(mine))
    points = pa.RecordBatch.from_pydict({
        **{c: same for c in vectors.PAYLOAD}, "lei": pa.array(keys), "country": pa.array(["DE", "US"] * 5_000),
        "embedding": pa.FixedSizeListArray.from_arrays(pa.array(mine.reshape(-1)), 8),
        "norm": pa.array(np.sqrt((mine.astype(float) ** 2).sum(axis=1))),
    })
    wanted = ["DE" if i % 2 else None for i in range(len(asked))]
    monkeypatch.setattr(vectors, "CELLS", 1 << 18, raising=False)
    scorer = vectors._Scorer(pa.array(range(len(asked))), asked, wanted, [None] * len(asked), 5, 6)
    tracemalloc.start()
    got = scorer.batch(points)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20  # one array of all scores takes 160 MB
    cosine = (asked @ mine.T.astype(float)) / (np.outer(np.sqrt((asked**2).sum(axis=1)), points.column("norm").to_numpy()) + 1e-9)
    rows = got.to_pydict()
    for i in range(0, len(asked), 97):
        order = sorted((j for j in range(len(mine)) if not i % 2 or j % 2 == 0), key=lambda j: (-round(cosine[i, j], 6), keys[j]))[:5]
        best = sorted((-s, k) for q, s, k in zip(rows["query_id"], rows["rank_score"], rows["lei"]) if q == i)[:5]
        assert [k for _, k in best] == [keys[j] for j in order]


def test_words_of_a_pair_are_compared_once(spark, plan):
    rows = spark.createDataFrame([("1 main st lyon", "1 main st osaka", "DE"), (None, "x", "US")], "a string, b string, c string")
    scored = scoring.with_signals(rows, address=("a", "b"))
    text = plan(scored).split("Initial Plan")[0]
    assert text.count("array_intersect(") == 1 and text.count("array_except(") == 2
    assert [r.address_similarity for r in scored.orderBy("c").collect()] == [round(18 / 23, 4), 0.0]  # the three shared words against four


def test_few_scores_are_made_in_double_precision(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from orgkin.operators import vectors

    draw = np.random.default_rng(4)
    asked, mine = draw.normal(size=(300, 16)), draw.normal(size=(6000, 16))
    asked[0], mine[:50], mine[50] = 0, mine[50:100] * 1e-12, 0  # no direction, or so small that the 1e-9 counts
    mine[3000:3100], asked[1] = mine[2900:3000], mine[2950] * 1e8
    keys = [f"K{i:05d}" for i in draw.permutation(len(mine))]
    same = pa.array(["x"] * len(mine))
    size = np.sqrt((mine**2).sum(axis=1))
    points = pa.RecordBatch.from_pydict({
        **{c: same for c in vectors.PAYLOAD}, "lei": pa.array(keys),
        "embedding": pa.FixedSizeListArray.from_arrays(pa.array(mine.reshape(-1)), 16), "norm": pa.array(size),
    })
    monkeypatch.setattr(vectors, "CELLS", 1 << 15)
    seen, exact = [], vectors._Scorer._exact
    monkeypatch.setattr(
        vectors._Scorer, "_exact", lambda self, m, s, q=None, r=None: seen.append(len(self.matrix) * len(m) if q is None else len(q)) or exact(self, m, s, q, r))
    got = vectors._Scorer(pa.array(range(300)), asked, [None] * 300, [None] * 300, 5, 6).batch(points).to_pydict()
    assert sum(seen) < 0.2 * 300 * 6000
    cosine = (asked @ mine.T) / (np.outer(np.sqrt((asked**2).sum(axis=1)), size) + 1e-9)
    for i in range(300):
        order = sorted(range(6000), key=lambda j: (-round(cosine[i, j], 6), keys[j]))[:5]
        best = sorted((-s, k) for q, s, k in zip(got["query_id"], got["rank_score"], got["lei"]) if q == i)[:5]
        assert [k for _, k in best] == [keys[j] for j in order]


def test_windows_of_an_end_share_one_pass(monkeypatch):
    import pyarrow as pa

    from orgkin.functions import align

    draw = random.Random(6)
    a = ["".join(draw.choices("abcdef", k=draw.choice((1, 2, 30, 70)))) for _ in range(60)]
    b = ["".join(draw.choices("abcdef", k=draw.randint(1, 90))) for _ in range(60)]
    read, plain = [], align._subsequence

    def counted(*args):
        read.append(int(args[6].sum()))  # characters read: the widths of all windows
        return plain(*args)

    monkeypatch.setattr(align, "_subsequence", counted)
    got = align.window_ratios(pa.array(a), pa.array(b))
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    inside = sum((len(y) - len(x) + 1) * len(x) for x, y in pairs)
    assert sum(read) <= 2 * inside + 4 * sum(len(x) for x, _ in pairs)

    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            before = row[:]
            for j, d in enumerate(y):
                row[j + 1] = before[j] + 1 if c == d else max(before[j + 1], row[j])
        return row[-1]

    for (x, y), ratio in list(zip(pairs, got))[:25]:
        widths = [(i, j) for i in range(len(y)) for j in range(i + 1, len(y) + 1)
                  if j - i == len(x) or (j - i < len(x) and (i == 0 or j == len(y)))]
        best = max(2.0 * lcs(x, y[i:j]) / (len(x) + j - i) for i, j in widths)
        if len(x) == len(y):
            best = max(best, max(2.0 * lcs(y, w) / (len(y) + len(w)) for k in range(1, len(x) + 1) for w in (x[:k], x[-k:])))
        assert ratio == best


def test_filings_are_dealt_before_they_are_widened(spark, plan, tmp_path):
    import datetime as dt

    from checks import queries as Q

    day = dt.datetime(2020, 1, 2)
    for name, rows, schema in (
        ("orders", [(i, i % 5, day) for i in range(40)] + [(3, 3, day), (50, None, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        ("customer", [(i, i % 2) for i in range(5)], "c_custkey long, c_nationkey int"),
        ("nation", [(0, "FRANCE", 3), (1, None, 1)], "n_nationkey int, n_name string, n_regionkey int"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    raw = Q.raw(spark, str(tmp_path))
    dealt = [line for line in plan(raw).splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 1 and "hashpartitioning(o_orderkey" in dealt[0]  # three narrow columns, not the filings
    assert sorted(r.ingest_ord for r in raw.collect()) == sorted([*range(40), 3])


def test_query_vectors_of_one_length_only():
    import numpy as np
    import pyarrow as pa
    import pytest

    from orgkin.operators import vectors

    got = vectors._query_matrix(pa.array([[1.0, 2.0], [3.0, None]], pa.list_(pa.float32())))
    assert got.shape == (2, 2) and got[0].tolist() == [1.0, 2.0] and np.isnan(got[1, 1])
    for odd in ([[1.0, 2.0, 3.0], [4.0]], [[1.0, 2.0], None]):
        with pytest.raises(ValueError):
            vectors._query_matrix(pa.array(odd, pa.list_(pa.float32())))


def test_pairs_that_meet_are_measured_where_they_meet(spark, monkeypatch):
    """Pairs grow with the square of the names: they are not shuffled, and names only once to their cells."""
    made = []
    settled = screening.settled
    monkeypatch.setattr(screening, "settled", lambda df, name: made.append((name, df)) or settled(df, name))
    names = _names(spark, {f"Common Thing Own{i}" for i in range(40)} | {"Common Shared"})
    found = screening.similar_names(names, names, 0.7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("\n") if " Exchange " in x]
    assert len(dealt) == 4 and all("REPARTITION_BY_NUM" in x and "key" in x for x in dealt)
    assert all(settled(df, "again").isEmpty() for name, df in made if name == "name-cells")  # no key has two cells
    assert found.filter("a = 'Common Shared' AND b = 'Common Shared'").count() == 1
