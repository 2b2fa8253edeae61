"""Sentence spans: cuts by their definition, and few interpreter steps a word."""

import random
import sys

import pytest

xxhash = pytest.importorskip("xxhash")

from orgkin.llm import sentence_spans as S  # noqa: E402


def test_cuts_are_the_last_least_words_of_all_windows():
    rng = random.Random(3)
    for size in (*range(25), 80):
        words = [rng.choice(["Aa ", "bΣ\n", "c\x1c", "İ  ", "dd ", "é ", "f "]) for _ in range(size)]
        hashes = [xxhash.xxh3_64_intdigest(w.rstrip().lower()) for w in words]
        windows = [range(at, at + S.WINDOW) for at in range(size - S.WINDOW + 1)]
        least = {min(w, key=lambda i: (hashes[i], -i)) for w in windows}
        assert S.cuts(words) == sorted(least)


def test_words_are_lowered_and_hashed_by_the_sentence():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) + rng.choice(["", "", "", "."]) for _ in range(4000))
    long = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(4000))
    for words in (text, long):
        calls = 0

        def count(_frame, event, _arg):
            nonlocal calls
            calls += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            S.runs(S.sentences(words))
        finally:
            sys.setprofile(None)
        assert calls < 4 * 4000
