"""The pipeline's stages one by one, each against what its input calls for."""

import collections
import hashlib
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from orgkin.llm import byte_bpe, html_text, jaccard_join
from orgkin.llm.common import written
from tests.llm.test_corpus_operators import _jaccard


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(written(stage(spark, tables[-1], ""), f"stage-{i}"))
    assert all(t.columns == docs.columns for t in tables[:-1])
    before, kept, single, replaced, mixed, last = [t.collect() for t in tables]
    assert 0 < len(kept) <= len(before)
    groups = _jaccard([(r.doc_id, r.text) for r in kept], 5, 80)
    assert sorted(r.doc_id for r in single) == sorted({root for _, root in groups.values()})
    assert sorted(r.doc_id for r in replaced) == sorted(r.doc_id for r in single)
    texts = {r.doc_id: r.text for r in replaced}
    assert mixed and all(texts[r.doc_id] == r.text for r in mixed)
    want = collections.Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in mixed)
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in last) == want


def test_long_id_lists_are_decoded_in_parts(monkeypatch):
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 3)
    ranks = byte_bpe.read_ranks(byte_bpe.vocabulary())
    tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    codec = byte_bpe.Codec(byte_bpe.sentencepiece_model(ranks), tokens, byte_bpe.pattern())
    for text in ("", "one two three, four five six seven", "naïve 日本語 text"):
        assert codec.decode(pa.array(codec.encode_all([text])[0])) == text.encode()


def test_decoding_makes_no_python_object_per_id():
    ranks = byte_bpe.read_ranks(byte_bpe.vocabulary())
    tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    codec = byte_bpe.Codec(byte_bpe.sentencepiece_model(ranks), tokens, byte_bpe.pattern())
    ids = np.arange(200_000, dtype=np.int32) % len(tokens)
    want = b"".join(tokens[i] for i in ids.tolist())
    codec.decode(pa.array(ids[:1]))
    tracemalloc.start()
    try:
        found = codec.decode(pa.array(ids))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == want and peak < 2 * len(want)
    assert codec.decode(pa.array([tokens.index(b"a")] * 3, pa.int32())) == b"aaa"
    with pytest.raises(TypeError):
        codec.decode(pa.array([1, None], pa.int32()))


def test_large_sets_stay_apart_that_differ_and_together_that_link():
    rng = np.random.default_rng(6)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    common, sets = draw(4_000), []
    for size in (1_000, 1_024, 1_030, 8_000, 16_000):
        base = draw(size)
        for gone in (0, size // 20, size // 9, size // 2):
            sets.append(np.unique(np.concatenate([base[gone:], draw(gone)])))
    sets += [np.unique(np.concatenate([common, draw(8_000)])) for _ in range(6)]  # a third in common
    shapes = [jaccard_join.histogram(x, jaccard_join.buckets(len(x))) for x in sets]
    assert {len(x) for x in shapes} > {256, 512, 4096}
    near = {}
    for i, a in enumerate(sets):
        near[i] = {i}
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                near[i].add(j)
    group = list(range(len(sets)))
    for a, b in jaccard_join._connected(shapes, np.array([len(x) for x in sets]), 80):
        group = [group[b] if g == group[a] else g for g in group]
    assert all(group[i] == group[j] for i in near for j in near[i])
    assert all(group.count(group[i]) == 1 for i in range(20, 26))  # were one block before
    assert len({group[i] for i in (0, 4, 8, 12, 16)}) == 5


def test_page_streams_are_not_shuffled_for_the_sizes_of_hosts(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 3}/{i}", f"<p>own{i} text{i}</p>") for i in range(9)], "page_id long, url string, html string"
    )
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = html_text.extracted(pages)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1  # pages with what is boilerplate there, nothing else
        assert {r.page_id: r.text for r in found.collect()} == {i: f"own{i} text{i}" for i in range(9)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
