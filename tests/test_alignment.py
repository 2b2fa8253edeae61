import random

import pyarrow as pa
import pytest

from orgkin.functions import scoring as S
from orgkin.functions.align import (
    lcs_lengths, partial_ratio, token_set_ratio, token_sort_ratio, window_ratios,
)
from orgkin.functions.numeric import percent, round_exact


def lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        last = [0]
        for j, y in enumerate(b):
            last.append(line[j] + 1 if x == y else max(line[j + 1], last[j]))
        line = last
    return line[-1]


def best_window(a, b):
    best = 0.0
    for n, h in ((a, b), (b, a)):
        if n and len(n) <= len(h):
            for k in range(1 - len(n), len(h)):
                w = h[max(k, 0):min(k + len(n), len(h))]
                best = max(best, 2 * lcs(n, w) / (len(n) + len(w)))
    return best


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)

    def word(lo, hi):
        return "".join(rng.choice("abcd é中😀 ") for _ in range(rng.randint(lo, hi)))

    a = [word(0, 30) for _ in range(200)] + [word(60, 150) for _ in range(20)]
    b = [word(0, 30) for _ in range(200)] + [word(60, 150) for _ in range(20)]
    return a + ["", "abc", "same", "same"], b + ["abc", "", "same", "same"]


def test_lcs_against_brute_force(pairs):
    a, b = pairs
    assert list(lcs_lengths(pa.array(a), pa.array(b))) == [lcs(x, y) for x, y in zip(a, b)]
    assert list(lcs_lengths(pa.array(["kitten", "Apple Inc", None]),
                            pa.array(["sitting", "Apple Incorporated", "x"]))) == [4, 9, 0]


def test_windows_against_brute_force(pairs):
    a, b = pairs
    got = window_ratios(pa.array(a), pa.array(b))
    assert got == pytest.approx([best_window(x, y) for x, y in zip(a, b)], abs=1e-12)


def test_kernels_do_not_depend_on_batching(pairs, monkeypatch):
    from orgkin.functions import align

    a, b = pa.array(pairs[0]), pa.array(pairs[1])
    whole = list(lcs_lengths(a, b)), list(window_ratios(a, b))
    monkeypatch.setattr(align, "_LANES", 64)
    assert (list(lcs_lengths(a, b)), list(window_ratios(a, b))) == whole
    assert list(lcs_lengths(a[:0], b[:0])) == []
    assert list(lcs_lengths(a[5:9], b[5:9])) == whole[0][5:9]


GOLDEN = [
    ("Apple Inc", "Apple Inc", 1.0, 1.0, 1.0),
    ("Apple Inc", "Apple Incorporated", 0.666667, 1.0, 0.8),
    ("Apple Inc", "Deutsche Bank AG", 0.32, 0.333333, 0.3253),
    ("ACME Inc", "Acme Incorporated", 0.4, 0.625, 0.49),
    ("Acme Inc", "Acme Incorporated", 0.64, 1.0, 0.784),
    ("Sample Company 1 Inc.", "SAMPLE COMPANY 1 INC.", 0.380952, 0.388889, 0.3841),
    ("", "Apple", None, None, 0.0),
    ("Apple", None, None, None, 0.0),
]


def test_name_similarity(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(GOLDEN)],
                               "i int, a string, b string")
    rows = S.with_signals(
        df.withColumns({"ts": token_sort_ratio("a", "b"), "pr": partial_ratio("a", "b")}),
        name=("a", "b"),
    ).orderBy("i").collect()
    for row, (_, _, sort, partial, score) in zip(rows, GOLDEN):
        assert row.name_similarity == score
        if sort is not None:
            assert row.ts == pytest.approx(sort, abs=1e-6)
            assert row.pr == pytest.approx(partial, abs=1e-6)


def test_address_similarity(spark):
    cases = [("123 Main St", "123 Main St", 1.0), ("123 Market Street", "123 Market St", 0.8696),
             ("123 Main St New York", "123 Main St Frankfurt", 0.7097), ("", "123 Main", 0.0)]
    df = spark.createDataFrame(cases, "a string, b string, want double")
    rows = S.with_signals(df, address=("a", "b")).collect()
    assert all(r.address_similarity == r.want for r in rows)


def test_scores_are_symmetric_and_bounded(spark, pairs):
    a, b = pairs
    df = spark.createDataFrame(list(zip(a, b)), "a string, b string")
    rows = df.select(
        token_sort_ratio("a", "b").alias("s1"), token_sort_ratio("b", "a").alias("s2"),
        token_set_ratio("a", "b").alias("t1"), token_set_ratio("b", "a").alias("t2"),
        partial_ratio("a", "b").alias("p1"), partial_ratio("b", "a").alias("p2"),
    ).collect()
    for r in rows:
        assert r.s1 == r.s2 and r.t1 == r.t2 and r.p1 == r.p2
        assert 0 <= r.s1 <= 1 and 0 <= r.t1 <= 1 and 0 <= r.p1 <= 1


def test_rounding_is_pythons(spark):
    rng = random.Random(3)
    numbers = [rng.random() for _ in range(2000)] + [i / 10**5 for i in range(0, 100000, 37)]
    numbers += [0.35 * i / 1e4 + 0.25 * j / 1e4 for i, j in zip(range(0, 9999, 7), range(1, 9999, 7))]
    numbers += [-0.12345, -1.0, 0.0, 1.0]
    rows = spark.createDataFrame([(v,) for v in numbers], "v double").select(
        "v", round_exact("v", 4).alias("r4"), round_exact("v", 2).alias("r2")
    ).collect()
    assert all(r.r4 == round(r.v, 4) and r.r2 == round(r.v, 2) for r in rows)


def test_percent_decisions_and_codes(spark):
    df = spark.createDataFrame([(0.85,), (0.65,), (0.6499,), (0.0,), (0.905,)], "s double")
    rows = df.select(S.decide("s").alias("d"), percent("s").alias("p")).collect()
    assert [r.d for r in rows] == ["same_entity", "needs_review", "different_entity",
                                   "different_entity", "same_entity"]
    assert [r.p for r in rows] == [85, 65, 65, 0, 91]


def test_codes_match_ignoring_case(spark):
    df = spark.createDataFrame([("us ", "US"), ("US", "DE"), ("", ""), (None, "US")], "a string, b string")
    assert [r[0] for r in df.select(S.same_code("a", "b")).collect()] == [1.0, 0.0, 0.0, 0.0]
