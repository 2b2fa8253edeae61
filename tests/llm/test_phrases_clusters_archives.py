"""Collocations, centroid clusters and archives against brute force, and on awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgkin.llm import centroids, collocations, warc

DOCS = "doc_id long, text string, lang string, source string, phrase string, rank int, f long"


def _phrases(rows):
    """Counts of all phrases by language, straight from the definition."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i: i + size])] += 1
    return f, n


def _best(rows, top=2000):
    f, n = _phrases(rows)
    out = collections.defaultdict(list)
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 30}
    covered = set()
    for (lang, words), longer in often.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * longer >= 80 * f[lang, words[i: i + size]]:
                    covered.add((lang, words[i: i + size]))
    for (lang, words), a in often.items():
        if (lang, words) not in covered:
            cuts = [
                (2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                for k in range(1, len(words))
            ]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    }


@pytest.fixture(scope="module")
def repeated(spark):
    """Words of few kinds, one pair in a third of them, odd separators, nulls and long texts."""
    rng = random.Random(5)
    vocabulary = ["ab", "Hot", "pair", "É", "x\x01y", "x", "日本", "no-break space", "the", "\x00"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(120)):
            words += ["hot", "Pair"] if rng.random() < 0.3 else [rng.choice(vocabulary)]
            if rng.random() < 0.1:
                words[-1] += rng.choice(".,;:!?\n\r\x0b\x0c") + rng.choice(["", "t"])
        rows.append((i, rng.choice([" ", "\t", "  "]).join(words), rng.choice(["en", "de", "", None])))
    rows += [(200, None, None), (201, "", "en"), (202, " .. ,\n", "en"), (203, "und only", "und")] * 2
    rows.append((None, "long text ends. " * 20_000, "fr"))
    return spark.createDataFrame([(*r, "s", "x", 1, 2) for r in rows], DOCS), [r[1:] for r in rows]


@pytest.mark.parametrize("budget", [collocations.BUDGET, 20_000, 200])
def test_collocations_are_those_of_brute_force(repeated, budget):
    docs, rows = repeated
    want = _best(rows)
    assert len(want) > 50
    found = [tuple(r) for r in collocations.collocations(docs.repartition(3), budget).collect()]
    assert len(found) == len(want) and set(found) == want


def test_collocations_keep_the_first_of_each_language(repeated):
    docs, rows = repeated
    assert {tuple(r) for r in collocations.collocations(docs, top=3).collect()} == _best(rows, 3)


def test_collocations_of_nothing(repeated):
    docs, _ = repeated
    for table in (docs.limit(0), docs.filter("text IS NULL OR text = ''")):
        assert collocations.collocations(table).collect() == []


def test_scores_do_not_overflow(spark):
    """The arithmetic of the score, at counts whose product passes 64 bits."""
    a, left, right = 4 * 10**18, 8 * 10**18, 9 * 10**18
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(F.expr(collocations.SCORE).alias("s")).first().s
    assert got == 2000000 * a // (left + right)


def test_blocks_end_between_pieces(monkeypatch, repeated):
    import pyarrow as pa

    _, rows = repeated
    batch = pa.RecordBatch.from_arrays(
        [pa.array([t or "" for t, _ in rows]), pa.array([x or "und" for _, x in rows])], ["text", "lang"])
    counts = []
    for size in (collocations.BLOCK, 50, 1):
        monkeypatch.setattr(collocations, "BLOCK", size)
        f = collections.Counter()
        for block in collocations._blocks(iter([batch.slice(1)])):
            kept = block.suffixes(block.links(np.arange(len(block.words) + 1) > 0))
            langs = block.langs.to_pylist()
            for row, phrase in zip(kept, block.joined(kept).to_pylist(), strict=True):
                f[langs[row[0] - 1], phrase] += 1
        counts.append(f)
    assert counts[0] == counts[1] == counts[2] and sum(counts[0].values()) > 5000


def test_word_hashes_depend_on_language_and_word_alone():
    import pyarrow as pa

    words = ["word", "drow", "É", "x" * 1000, "x" * 1001, "a", "aa", "\x00", "\x00\x00"]
    langs = ["en", "de", "", "en"]
    both = [(x, w) for x in langs for w in words]
    got = collocations.word_hashes(pa.array([x for x, _ in both]), pa.array([w for _, w in both])).tolist()
    assert len(set(got)) == len(set(both)) and len(dict(zip(both, got, strict=True))) == len(set(both))
    part = collocations.word_hashes(pa.array(["no", "en"]).slice(1), pa.array(["no", "É"]).slice(1))
    assert part.tolist() == [got[both.index(("en", "É"))]]


def _kmeans(rows, k, rounds):
    """Whole-number k-means, one vector after the other."""
    kept = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v, i) for i, v in rows)
    points = [list(v) for _, v, _ in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(points))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in rows:
            own[nearest(v)[1]].append(v)
        for j, vs in own.items():
            points[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in rows]
    per = collections.Counter()
    for _, c, d in found:
        per[c] += d

    def long(x):
        return x if x < 2**63 else None

    return {
        (i, c, d, long(per[c]), long(sum(per.values())), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
        for i, c, d in found
    }


VECTORS = "vec_id long, embedding array<double>, label int, cluster int, distance long"


@pytest.mark.parametrize("spread", [1.0, 0.05, 3e6])
def test_clusters_are_those_of_brute_force(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    x = rng.normal(size=(400, 8)) * spread
    x[50:60] = x[50]  # ties
    x[60] = -x[61]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(7, [float(c) for c in x[7]]), (None, [0.0] * 8)]
    bad = [(900, None), (901, []), (902, [1.0] * 7), (903, [None] + [1.0] * 7), (904, [float("nan")] * 8),
           (905, [float("inf")] + [0.0] * 7), (906, [1e300] * 8)]
    table = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows + bad], VECTORS)
    whole = [(i, tuple(int(np.floor(64 * c)) for c in v)) for i, v in rows]
    got = [tuple(r) for r in centroids.clusters(table.repartition(3), k=6, length=8).collect()]
    assert len(got) == len(rows) and set(got) == _kmeans(whole, 6, 3)


def test_clusters_of_few_vectors(spark):
    table = spark.createDataFrame([(1, [0.5, 1.0], 1, 2, 3), (2, [0.5, 1.0], 1, 2, 3)], VECTORS)
    got = {tuple(r)[:3] for r in centroids.clusters(table, length=2).collect()}
    assert got == {(1, 0, 0), (2, 0, 0)}
    assert centroids.clusters(table.limit(0)).collect() == []


def test_threshold_walk_finds_the_nearest():
    rng = np.random.default_rng(0)
    for k, dims, most in ((1, 3, 5), (2, 1, 3), (16, 64, 100), (16, 5, 2), (9, 4, 2**40)):
        points = rng.integers(-most, most, size=(k, dims))
        vectors = rng.integers(-most, most, size=(300, dims))
        number, best = centroids.SortedLists(points.tolist()).nearest(vectors)
        exact = ((vectors[:, None].astype(object) - points[None].astype(object)) ** 2).sum(2)
        assert number.tolist() == [min(range(k), key=lambda c: (row[c], c)) for row in exact]
        assert best.tolist() == [min(row) for row in exact]


PAGES = "page_id long, url string, html string, digest string, frame int, payload int"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "copied text é " * 20
    rows = [
        (5, "http://a/5", big), (3, "http://a/3 with space\r\nX: y", big), (9, None, big), (3, "http://a/z", big),
        (1, "http://b", None), (2, "http://b", ""), (4, "http://c", "short"), (6, "http://c", "short"),
        (7, "http://d", "y" * 99), (8, "http://d", "y" * 99), (10, "http://e", "z" * 100), (11, "http://e", "z" * 100),
        (12, "http://f", "".join(f"<b>{i}</b>\r\n\r\n" for i in range(300_000))), (13, "http://g", "Content-Length: 5\r\n\r\n" * 9),
        (14, "http://h", "w" * 200), (14, "http://h", "w" * 200), (14, "http://h", "w" * 200), (None, "http://i", "w" * 200),
        (None, None, None), (None, None, None),
    ]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES), rows


def test_archives_give_every_page_back(spark, pages):
    table, rows = pages
    first = {}
    for i, _, html in rows:
        text = html or ""
        first[text] = min(first.get(text, (True, 0)), (i is None, i))
    want, seen = collections.Counter(), set()
    for i, _, html in rows:
        text = (html or "")
        raw = text.encode()
        again = len(raw) >= 100 and ((i is None, i) != first[text] or text in seen)
        if not again:
            seen.add(text)
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[text][1] if again else None] += 1
    assert collections.Counter(map(tuple, warc.page_digests(table.repartition(3)).collect())) == want


def test_single_records_are_read_by_their_place(spark, pages, tmp_path):
    import zstandard

    table, rows = pages
    folder, index = warc.write_archives(table.coalesce(1), str(tmp_path / "archives"), frame=500)
    every = warc.read_records(folder, index).collect()
    assert len({r.record_id for r in every}) == len(rows) and index.count() == len(rows)
    texts = collections.Counter(h or "" for _, _, h in rows)
    kept = collections.Counter(bytes(r.payload).decode() for r in every if r.record_type == "response")
    assert all(kept[t] == (n if len(t.encode()) < 100 else 1) for t, n in texts.items())
    assert all(r.payload is None and r.refers_to_record for r in every if r.record_type == "revisit")
    one = warc.read_records(folder, index.filter("record_id LIKE 'urn:x-page:13:%'")).collect()
    assert [bytes(r.payload).decode() for r in one] == ["Content-Length: 5\r\n\r\n" * 9]
    # any reader of Zstandard sees whole WARC files; frames stand alone; records keep to frames
    total = 0
    for path in (tmp_path / "archives").iterdir():
        data = path.read_bytes()
        with path.open("rb") as f:
            places = warc.frames(f, len(data))
        own = [zstandard.ZstdDecompressor().decompress(data[a: a + p], max_output_size=n) for a, p, n in places]
        assert all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") for x in own)
        with path.open("rb") as f:
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(own)
        total += len(re.findall(rb"^WARC-Record-ID", b"".join(own), re.M))
    assert total == len(rows)


def test_damaged_archives_are_noticed(spark, pages, tmp_path):
    table, _ = pages
    folder, index = warc.write_archives(table.coalesce(1), str(tmp_path / "archives"))
    for path in (tmp_path / "archives").iterdir():
        path.write_bytes(path.read_bytes()[:-4] + b"\0\0\0\0")
    with pytest.raises(Exception, match="no seek table"):
        warc.read_records(folder, index).collect()


def test_archives_of_nothing(spark, pages):
    assert warc.page_digests(pages[0].limit(0)).collect() == []
