"""The robust estimate of the quality rules, against many random starts in NumPy."""

import numpy as np
import pytest
from orgkin.llm import quality_rules as rules

TABLE = "doc_id long, lang string, source string, _x0 long, _x1 long, _x2 long, _x3 long"
FLOORS = np.array(list(rules.FLOORS.values())) * rules.SCALE


def _estimate(x):
    mean = x.mean(axis=0)
    return mean, x.T @ x / len(x) - np.outer(mean, mean) + np.diag(FLOORS**2)


def _squared(x, mean, scatter):
    return np.einsum("ij,ij->i", (x - mean) @ np.linalg.inv(scatter), x - mean)


def _least_determinant(x, rng):
    half, best = int(np.ceil(rules.SUBSET * len(x))), (np.inf,)
    for _ in range(100):
        est = _estimate(x[rng.choice(len(x), 5, False)])
        for _ in range(40):
            est = _estimate(x[np.argsort(_squared(x, *est), kind="stable")[:half]])
        best = min(best, (np.linalg.slogdet(est[1])[1], *est), key=lambda e: e[0])
    return best[1:]


@pytest.fixture
def numbers(spark, monkeypatch):
    """The rules' verdicts on rows whose statistics are given."""
    monkeypatch.setattr(rules, "base_statistics", lambda docs: docs)
    monkeypatch.setattr(rules, "_numbers", lambda stats: stats.selectExpr(
        "*", "doc_id < 0 AS base_failed",
        *[f"1L AS {c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    ))
    return lambda rows: {r.doc_id: r for r in rules.quality_rules(spark.createDataFrame(rows, TABLE)).collect()}


def test_the_least_determinant_of_several_starts_wins(numbers):
    """Steps from the medians alone end at a scatter that takes in a clump of a fifth of the rows."""
    rng = np.random.default_rng(0)
    rows, groups = [], {}
    for lang, wide, off in (("a", 5_000, 6_000), ("b", 20_000, 10_000), ("c", 20_000, 6_000)):
        t = rng.normal(0, wide, 320)
        line = np.stack([t, t, 0 * t, 0 * t], axis=1) + rng.normal(0, 300, (320, 4))
        clump = np.array([off, -off, 0, 0]) + rng.normal(0, 100, (80, 4))
        groups[lang] = np.concatenate([line, clump]).round()
        rows += [(len(rows) + i, lang, "s", *map(int, x)) for i, x in enumerate(groups[lang])]
    found = numbers(rows)
    for g, (lang, x) in enumerate(groups.items()):
        d2 = _squared(x, *_least_determinant(x, rng))
        assert d2[320:].min() * 3.357 / max(1, np.median(d2)) > 2 * rules.LIMIT
        mine = [found[400 * g + i] for i in range(400)]
        assert all(r.kept for r in mine[:320]) and not any(r.kept for r in mine[320:]), lang


def test_documents_left_over_are_judged_by_all(numbers):
    rng = np.random.default_rng(1)
    rows = [(i, "a", "s", *map(int, rng.normal(0, 500, 4))) for i in range(300)]
    rows += [(300 + i, "b", None, *map(int, rng.normal(0, 500, 4))) for i in range(5)]
    rows += [(400, "b", None, 60_000, 0, 0, 0), (-1, "b", "s", 0, 0, 0, 0)]
    found = numbers(rows)
    assert {i for i, r in found.items() if not r.kept} == {400, -1}
    assert found[-1].outlier_d2 is None and found[400].outlier_d2 > rules.LIMIT
    assert all(r.kept for i, r in numbers(rows[-7:]).items() if i != -1)  # too few in all
