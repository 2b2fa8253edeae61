"""Substring deduplication by sliding spans of sentences.

Every run of several consecutive sentences is hashed; all runs of the corpus meet by hash.
The first place of a run, by id and position, keeps it; sentences covered by any other place
are removed. Only hashes are shuffled to be counted. Those that recur set a bit in a bitmap of
a fixed size, and places whose hash has none never leave their task; what the bitmap lets
through by collision is counted again. A sentence of more than WINDOW words counts as several. It is cut by content:
after the word of least hash in each WINDOW consecutive words. So cuts depend on the words
around them only, a piece has WINDOW words at most, and a passage spliced into other text is
cut alike everywhere but for WINDOW words at either end: from 49 words on it holds a whole run. Of a repeated passage up to a window may stay at its
start and two at its end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import documents, written

SENTENCES = 3  # least sentences in a run
LEAST_WORDS = 20  # and words: runs of a few short sentences meet by chance
BITS = 27  # the bitmap of recurring hashes has 2 ** BITS bits, 16 MB
WINDOW = 10  # words of which one is cut after; shorter sentences stay whole
SENTENCE = re.compile(r"[^.!?\n]*[.!?]*[\"')\]”’]*(?:\s+|$)|[^.!?\n]+[.!?]*", re.S)
WORD = re.compile(r"\S+\s*")


def cuts(words: list[str]) -> list[int]:
    """Places of the words of least hash in all windows, the last of equal ones."""
    hashes = list(map(xxhash.xxh3_64_intdigest, "".join(words).lower().split()))
    out, best, least = [], -1, -1
    for end in range(WINDOW - 1, len(hashes)):
        if best <= end - WINDOW:
            window = hashes[end - WINDOW + 1 : end + 1]
            least = min(window)
            best = end - window[::-1].index(least)
            out.append(best)
        elif hashes[end] <= least:
            best, least = end, hashes[end]
            out.append(best)
    return out


def sentences(text: str) -> list[str]:
    """The text in pieces that join to it again: sentences, or parts of long ones."""
    out = []
    for s in SENTENCE.findall(text):
        if not s:
            continue
        words = WORD.findall(s) if len(s) > 2 * WINDOW else ()
        if len(words) <= WINDOW:
            out.append(s)
            continue
        words[0] = s[: len(s) - sum(map(len, words))] + words[0]
        at = 0
        for end in [i + 1 for i in cuts(words) if i + 1 < len(words)] + [len(words)]:
            out.append("".join(words[at:end]))
            at = end
    return out


def runs(pieces: list[str]) -> list[tuple[int, int, int]]:
    """``start, end, hash`` of the shortest run from each sentence that is long enough.

    Case and white space do not count. Pieces without a word take no part.
    """
    parts = [p.lower().split() for p in pieces]
    places = [i for i, w in enumerate(parts) if w]
    sizes = [len(parts[i]) for i in places]
    hashes = b"".join([xxhash.xxh3_64_digest(" ".join(parts[i])) for i in places])
    out, end, words = [], 0, 0
    for at, first in enumerate(places):
        while end < len(places) and (end - at < SENTENCES or words < LEAST_WORDS):
            words += sizes[end]
            end += 1
        if end - at < SENTENCES or words < LEAST_WORDS:
            break
        out.append((first, places[end - 1] + 1, xxhash.xxh3_64_intdigest(hashes[8 * at : 8 * end])))
        words -= sizes[at]
    return out


def _spans(batches):
    for batch in batches:
        ids, rows, texts = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text")
        doc, row, span, hashed = [], [], [], []
        for i, r, text in zip(ids, rows, texts, strict=True):
            for a, b, h in runs(sentences(text.as_py())):
                doc.append(i)
                row.append(r)
                span.append(a << 32 | b)
                hashed.append(h - (1 << 63))
            if len(doc) > 200_000:
                yield _span_batch(doc, row, span, hashed)
                doc, row, span, hashed = [], [], [], []
        yield _span_batch(doc, row, span, hashed)


def _span_batch(*columns):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "row", "span", "hash"])


def _recurring(bits: bytes):
    """Keeps the places whose hash has its bit."""
    def kept(batches):
        words = np.frombuffer(bits, np.int64)
        for batch in batches:
            at = batch.column("hash").to_numpy() & ((1 << BITS) - 1)
            yield batch.filter(pa.array((words[at >> 6] >> (at & 63) & 1).astype(bool)))
    return kept


def _bitmap(hashes: DataFrame) -> bytes:
    """2 ** BITS bits, one set for the low bits of each hash; or-ed together on the cluster."""
    bit = hashes.select(F.col("hash").bitwiseAND((1 << BITS) - 1).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("mask")
    ).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy()
    return out.tobytes()


def _cut(batches):
    for batch in batches:
        ids, kept, counts, removed = batch.column("doc_id"), [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            pieces = sentences(text.as_py() or "")
            gone = bytearray(len(pieces))
            for a, b in (divmod(span, 1 << 32) for span in spans.as_py() or ()):
                if b <= len(gone):
                    gone[a:b] = b"\x01" * (b - a)
            counts.append(len(pieces))
            removed.append(sum(gone))
            kept.append("".join(p for p, g in zip(pieces, gone, strict=True) if not g) if text.is_valid else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
            ["doc_id", "text", "n_sentences", "n_removed"],
        )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, text, n_sentences, n_removed``.

    What is left of a text stays as it was written. Null texts stay null. Rows without an id
    take no part and stay whole. Rows that share an id are documents of their own, in the
    order of a hash of their text; rows that also share the text are one document at one
    place: a run that only they share stays. Repeats inside a document are removed too. Other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    places = "doc_id long, row long, span long, hash long"
    spans = written(rows.dropna().mapInArrow(_spans, places), "spans")
    twice = spans.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    likely = spans.mapInArrow(_recurring(_bitmap(twice)), places)
    place = F.struct("doc_id", "row", F.shiftright("span", 32).alias("start"))
    likely = written(likely, "recurring-spans")
    first = likely.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = likely.join(first, "hash").filter(place != F.col("first"))
    covered = again.groupBy("doc_id", "row").agg(F.collect_list("span").alias("spans"))
    return rows.join(covered, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, text string, n_sentences long, n_removed long"
    )


def query(spark, sf_dir):
    return deduplicated(documents(spark, sf_dir))
