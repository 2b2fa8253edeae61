"""Phrase collocation mining over depth-truncated suffix subtrees, built group by group.

The suffixes of all pieces, cut after four words, form one tree; the total of a node is how
often its phrase occurs. The tree is partitioned vertically: a first scan counts words (and
the pairs and triples that are frequent within a block of text), and word prefixes are dealt
to groups that hold BUDGET suffixes at most. A prefix that outgrows its share of a group is
replaced by its extensions by one word. Another scan sends each prefix's subtree of a block,
one row each, to its group, whose subtrees are built in memory, independently of all others;
leaf totals are summed up towards the root. Only prefixes that were extended meet in several
groups; their totals are added up at the end.

The tree grows in two rounds, to two words and then to all, and only branches that are still
open grow on: a phrase occurs at most as often as each of its words and pairs, so suffixes end
before a word or pair that is too rare. Those that are not go to the tasks as bitmaps of a
fixed size; what these let through by collision is counted and dropped at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import documents, runs_of, written

LEAST = 30  # occurrences of a candidate
DEPTH = 4  # words of the longest candidate
TOP = 2_000
SHARE = 80  # percent of a phrase's occurrences inside one longer candidate
BUDGET = 1_000_000  # suffixes that a task holds at once
BLOCK = 10_000_000  # bytes of text that are turned into subtrees at once
BITS = 25  # the bitmap of words has 2 ** BITS bits, 4 MB
OTHER = "und"  # language of documents without one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
# 0: part of a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _codes(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense numbers for equal values, in order of first appearance, and how many there are."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy(), len(coded.dictionary)


def _sample_rows(codes: np.ndarray, n: int) -> np.ndarray:
    """A row of each code."""
    rows = np.zeros(n, np.int64)
    rows[codes] = np.arange(len(codes))
    return rows


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """A number of 64 bits for each (language, word): a polynomial of the word's bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    if not len(words):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]: offsets[-1]].astype(np.uint64)
    offsets -= offsets[0]
    length = np.diff(offsets)
    powers = np.full(int(length.max()) + 1, 0x9E3779B97F4A7C15, np.uint64)
    powers = np.multiply.accumulate(powers)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], length)
    own = np.add.reduceat(data * powers[place], offsets[:-1]) + powers[length]
    lang = langs.dictionary_encode()
    seeds = np.array([xxhash.xxh64_intdigest(x) for x in lang.dictionary.to_pylist()], np.uint64)
    return _mixed(seeds[lang.indices.to_numpy()], own)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a prefix from those of its beginning and its last word."""
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def phrase_hashes(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The same for phrases, all of as many words."""
    words = pc.split_pattern(phrases, " ").flatten()
    size = len(words) // max(len(phrases), 1)
    each = pa.array(np.repeat(np.arange(len(phrases)), size))
    own = word_hashes(langs.take(each), words.take(pa.array(np.arange(len(words))))).reshape(len(phrases), size)
    out = own[:, 0]
    for k in range(1, size):
        out = _mixed(out, own[:, k])
    return out


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each hash."""
    at = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


class Block:
    """Words of a stretch of text: ``word`` numbers distinct (language, word) pairs from 1 on.

    ``words`` and ``langs`` hold the pairs, ``piece`` the piece of each word.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, langs: pa.Array):
        """``starts``: where each document begins in ``data``; ``langs``: one for each."""
        kind = _KIND[data]
        word = kind == 0
        first = np.zeros(len(data) + 1, bool)
        first[starts[starts < len(data)]] = True
        first[-1] = True
        joined = word[1:] & word[:-1] & ~first[1:-1]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~joined
        ends[:-1] &= ~joined
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        offsets = np.zeros(len(begin) + 1, np.int32)
        np.cumsum(end - begin, out=offsets[1:])
        spelled = pa.StringArray.from_buffers(
            len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[word]))
        ).dictionary_encode()
        cuts = np.flatnonzero((kind == 2) | first[:-1])
        self.piece = np.searchsorted(cuts, begin, "right").astype(np.int32)
        doc = np.searchsorted(starts, begin, "right") - 1
        lang = langs.dictionary_encode()
        own = lang.indices.to_numpy().astype(np.int64)[doc]
        many = max(len(spelled.dictionary), 1)
        pair, n = _codes(own * many + spelled.indices.to_numpy())
        rows = _sample_rows(pair, n)
        self.word = pair + np.int32(1)
        self.langs = lang.dictionary.take(pa.array(own[rows]))
        self.words = spelled.dictionary.take(pa.array(spelled.indices.to_numpy()[rows]))
        self.counts = np.bincount(pair, minlength=n)

    def hashes(self) -> np.ndarray:
        """The hash of each pair; entry 0 stands for no word."""
        return np.concatenate([np.zeros(1, np.uint64), word_hashes(self.langs, self.words)])

    def links(self, keep: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
        """Whether a phrase can go on from each word to the next one: both are kept (a flag per
        number), stand in one piece and are in the bitmap of ``pairs``, where there is one."""
        kept = keep[self.word]
        out = np.zeros(len(kept) + DEPTH, bool)
        out[: max(len(kept) - 1, 0)] = kept[1:] & kept[:-1] & (self.piece[1:] == self.piece[:-1])
        if pairs is not None:
            at, hashes = np.flatnonzero(out), self.hashes()
            out[at] = _in(pairs, _mixed(hashes[self.word[at]], hashes[self.word[at + 1]]))
        return out

    def suffixes(self, links: np.ndarray, least: int = 2, most: int = DEPTH) -> np.ndarray:
        """A row of DEPTH word numbers for each word from which a phrase of ``least`` words goes
        on: up to ``most`` words, then 0."""
        at = np.flatnonzero(links)
        for k in range(1, least - 1):
            at = at[links[at + k]]
        word = np.append(self.word, np.zeros(DEPTH, np.int32))
        rows = np.zeros((len(at), DEPTH), np.int32)
        rows[:, 0] = word[at]
        alive = np.ones(len(at), bool)
        for k in range(1, most):
            alive &= links[at + k - 1]
            rows[:, k] = np.where(alive, word[at + k], 0)
        return rows

    def joined(self, rows: np.ndarray) -> pa.Array:
        """The words of each row, joined by spaces up to the first 0."""
        spelled = pa.concat_arrays([pa.nulls(1, pa.string()), self.words])
        first, *more = [spelled.take(pa.array(rows[:, k])) for k in range(rows.shape[1])]
        # a row of nulls alone would be left out, not empty
        return pc.binary_join_element_wise(first.fill_null(""), *more, " ", null_handling="skip")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The texts in stretches of about BLOCK bytes, which end where a document or piece ends."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        if not len(texts) or offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
        starts = offsets - offsets[0]
        at = 0
        while at < len(data):
            end = at + BLOCK
            if end >= len(data):
                end = len(data)
            else:
                edge = int(starts[np.searchsorted(starts, end)])
                while end < edge:
                    found = np.flatnonzero(_KIND[data[end: min(edge, end + 65_536)]] == 2)
                    if len(found):
                        edge = end + int(found[0])
                    end = min(edge, end + 65_536)
            first = int(np.searchsorted(starts, at, "right")) - 1
            last = int(np.searchsorted(starts, end, "left"))
            yield Block(_LOWER[data[at:end]], np.maximum(starts[first:last] - at, 0), batch.column("lang")[first:last])
            pa.default_memory_pool().release_unused()
            at = end


def _prefix_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word occurs in a block, and each pair and triple with LEAST
    occurrences there."""
    for block in _blocks(batches):
        found = [(block.langs, block.words, block.counts)]
        rows = block.suffixes(block.links(np.append(False, block.counts >= LEAST)))
        for k in range(2, DEPTH):
            rows = rows[rows[:, k - 1] > 0]
            codes = rows[:, 0]
            for c in range(1, k):
                codes, n = _codes(codes.astype(np.int64) * (len(block.words) + 1) + rows[:, c])
            if not len(codes):
                break
            counts = np.bincount(codes, minlength=n)
            kept = counts >= LEAST
            heads = rows[_sample_rows(codes, n)[kept]]
            found.append((block.langs.take(pa.array(heads[:, 0] - 1)), block.joined(heads[:, :k]), counts[kept]))
            rows = rows[kept[codes]]
        for langs, phrases, counts in found:
            yield pa.RecordBatch.from_arrays(
                [langs, phrases, pa.array(counts.astype(np.int64))], ["lang", "phrase", "n"]
            )


class Groups:
    """Which group a suffix belongs to: by the hash of its shortest prefix that is not heavy."""

    def __init__(self, heavy: list[list[int]], groups: int):
        """``heavy``: hashes of the heavy prefixes of one, two and three words."""
        self.heavy = [np.array(sorted(h), np.uint64) for h in heavy]
        self.groups = groups

    def of(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group and length of the prefix of each suffix; ``rows`` say whose hashes its words have."""
        own = hashes[rows[:, 0]]
        length = np.ones(len(own), np.int64)
        for k, heavy in enumerate(self.heavy):
            on = (length == k + 1) & np.isin(own, heavy)
            own[on] = _mixed(own[on], hashes[rows[on, k + 1]])
            length[on] = k + 2
        own ^= own >> np.uint64(32)
        return (own % np.uint64(self.groups)).astype(np.int32), length


def _subtrees(words: bytes, pairs: bytes | None, groups: Groups, least: int, most: int):
    """Turns texts into a row for each prefix of a block: what follows it there, how often.

    Phrases have ``least`` to ``most`` words, those and whose pairs are in the bitmaps."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(words, np.uint8)
        often_pairs = None if pairs is None else np.frombuffer(pairs, np.uint8)
        for block in _blocks(batches):
            hashes = block.hashes()
            keep = _in(often, hashes)
            keep[0] = False
            rows = block.suffixes(block.links(keep, often_pairs), least, most)
            if not len(rows):
                continue
            many = len(block.words) + 1
            codes = [rows[:, 0]]
            for k in range(1, most):
                code, n = _codes(codes[-1].astype(np.int64) * many + rows[:, k])
                codes.append(code)
            counts = np.bincount(codes[-1], minlength=n)
            one = _sample_rows(codes[-1], n)
            rows, codes = rows[one], [c[one] for c in codes]
            group, length = groups.of(hashes, rows)
            for size in range(1, most + 1):
                mine = np.flatnonzero(length == size)
                if not len(mine):
                    continue
                # an extended prefix shares its row with the others of its beginning and group
                shown = max(size - 1, 1)
                row = codes[shown - 1][mine].astype(np.int64) * groups.groups + group[mine]
                order = np.argsort(row)
                mine, row = mine[order], row[order]
                own = rows[mine]
                first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                ends = pa.array(np.append(first, len(own)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group[mine][first]), pa.array(np.full(len(first), size, np.int32)),
                        block.langs.take(pa.array(own[first, 0] - 1)), block.joined(own[first, :shown]),
                        pc.binary_join(pa.ListArray.from_arrays(ends, block.joined(own[:, shown:])), "\n"),
                        pa.ListArray.from_arrays(ends, pa.array(counts[mine].astype(np.int32))),
                    ],
                    ["group", "size", "lang", "prefix", "tails", "counts"],
                )

    return made


#: ``size`` is the length of the prefixes that choose the group; ``prefix`` is the part of them
#: that all tails of a row share, and a suffix that ends earlier has fewer words than ``size``.
SUBTREES = "group int, size int, lang string, prefix string, tails string, counts array<int>"


def _columns(tree: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Suffixes of a group as rows of word numbers (the first one with the language's number
    times the words), their ``size``, how often they occur, the words and the languages."""
    tree = tree.combine_chunks()
    prefix = pc.split_pattern(tree["prefix"].combine_chunks(), " ")
    tails = pc.split_pattern(tree["tails"].combine_chunks(), "\n")
    of_row = np.repeat(np.arange(len(tails)), pc.list_value_length(tails).to_numpy())
    tail = pc.split_pattern(tails.flatten(), " ")
    spelled = pa.concat_arrays([prefix.flatten(), tail.flatten()]).dictionary_encode()
    numbers = spelled.indices.to_numpy()
    own, more = pc.list_value_length(prefix).to_numpy(), pc.list_value_length(tail).to_numpy()
    head = np.full((len(prefix), DEPTH), -1, np.int64)

    def place(out, lengths, shift, values):
        row = np.repeat(np.arange(len(lengths)), lengths)
        within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = within + shift[row]
        fits = at < DEPTH  # a tail that is empty splits into one empty word
        out[row[fits], at[fits]] = values[fits]

    place(head, own, np.zeros(len(own), np.int64), numbers[: own.sum()])
    rows = head[of_row]
    place(rows, more, own[of_row], numbers[own.sum():])
    empty = pc.index(spelled.dictionary, "").as_py()
    if empty >= 0:
        rows[rows == empty] = -1
    lang = tree["lang"].combine_chunks().dictionary_encode()
    rows[:, 0] += lang.indices.to_numpy().astype(np.int64)[of_row] * len(spelled.dictionary)
    counts = tree["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
    return rows, tree["size"].to_numpy()[of_row], counts, spelled.dictionary, lang.dictionary


def _totals(least: int):
    """The nodes of ``least`` words and more of each group's tree, with their totals; nodes
    whose total is known to be below LEAST stay out."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in runs_of(batches, "group"):
            yield from _nodes(tree, least)

    return made


def _nodes(tree: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    rows, size, counts, words, langs = _columns(tree)
    many = len(words) + 1
    depth = (rows >= 0).sum(1)
    at = [_codes(rows[:, 0])]
    for k in range(1, DEPTH):  # downwards: children of the nodes of k words
        here = np.full(len(rows), -1, np.int64)
        deep = depth > k
        codes, n = _codes(at[-1][0][deep].astype(np.int64) * many + rows[deep, k])
        here[deep] = codes
        at.append((here, n))
    below = None
    for k in range(DEPTH - 1, least - 2, -1):  # upwards: leaf totals, then sums of children
        node, n = at[k]
        total = np.zeros(n, np.int64)
        ends = depth == k + 1
        np.add.at(total, node[ends], counts[ends])
        if below is not None:
            child, sums = below
            np.add.at(total, node[child], sums)
        on = node >= 0
        rep = np.zeros(n, np.int64)
        rep[node[on]] = np.flatnonzero(on)
        below = rep, total
        kept = (total >= LEAST) | (size[rep] > k + 1)
        chosen = rows[rep[kept], : k + 1]
        lang, chosen[:, 0] = np.divmod(chosen[:, 0], len(words))
        phrase = pc.binary_join_element_wise(*[words.take(pa.array(chosen[:, c])) for c in range(k + 1)], " ")
        yield pa.RecordBatch.from_arrays(
            [langs.take(pa.array(lang)), phrase, pa.array(total[kept])], ["lang", "phrase", "f"]
        )


def _size(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = phrase_hashes(batch.column("lang"), batch.column("phrase"))
        at = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(1 << (at & 7))], ["byte", "mask"])


def bitmap(phrases: DataFrame) -> bytes:
    """2 ** BITS bits by the hash of language and phrase; all phrases have as many words."""
    masks = phrases.select("lang", "phrase").mapInArrow(_bits, "byte long, mask long")
    table = masks.groupBy("byte").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (BITS - 3), np.uint8)
    out[table["byte"].to_numpy()] = table["mask"].to_numpy()
    return out.tobytes()


def _grown(rows: DataFrame, words: bytes, pairs: bytes | None, groups: Groups, least: int, most: int) -> DataFrame:
    """``lang, phrase, size, f`` of the phrases of those lengths that occur LEAST times."""
    return (
        rows.mapInArrow(_subtrees(words, pairs, groups, least, most), SUBTREES)
        .repartition("group").sortWithinPartitions("group")
        .mapInArrow(_totals(least), "lang string, phrase string, f long")
        .groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= LEAST)
        .select("lang", "phrase", _size("phrase").alias("size"), "f")
    )


def phrase_counts(docs: DataFrame, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f``: every phrase of up to DEPTH words that occurs LEAST times in
    its language; and ``lang, n``: all word occurrences of each language.

    ``budget`` bounds the suffixes of a group: groups are filled to half of it on average,
    with prefixes of a quarter at most. Tasks are told the heavy prefixes, 8 bytes each, of
    which there are at most 12 for each ``budget`` words of the corpus.
    """
    rows = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit(OTHER)).alias("lang"),
    )
    prefixes = written(
        rows.mapInArrow(_prefix_counts, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(
            F.sum("n").alias("n")).withColumn("size", _size("phrase")),
        "collocation-prefixes",
    )
    words = prefixes.filter("size = 1").select("lang", "phrase", "size", F.col("n").alias("f"))
    often = words.filter(F.col("f") >= LEAST)
    heavy: list[list[int]] = [[] for _ in range(DEPTH - 1)]
    for r in prefixes.filter(F.col("n") > budget // 4).collect():
        hashed = phrase_hashes(pa.array([r["lang"]]), pa.array([r["phrase"]]))
        heavy[r["size"] - 1].append(int(hashed[0]))

    def groups(counted: DataFrame, prefixes: list[list[int]]) -> Groups:
        return Groups(prefixes, max(1, -(-2 * (counted.agg(F.sum("f")).first()[0] or 0) // budget)))

    bits = bitmap(often)
    pairs = written(_grown(rows, bits, None, groups(often, heavy[:1]), 2, 2), "collocation-pairs")
    more = written(_grown(rows, bits, bitmap(pairs), groups(pairs, heavy), 3, DEPTH), "collocation-phrases")
    return often.unionByName(pairs).unionByName(more), words.groupBy("lang").agg(F.sum("f").alias("n"))


def _part(first: Column | int, length: Column | int) -> Column:
    return F.concat_ws(" ", F.slice("words", first, length))


#: floor(2000000 * a / (l + r)) in whole numbers of up to 38 digits
SCORE = (
    "CAST((CAST(2000000 AS DECIMAL(18,0)) * CAST(a AS DECIMAL(19,0))) DIV "
    "(CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)"
)


def collocations(docs: DataFrame, budget: int = BUDGET, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Null texts are empty, a null language is ``und``. Repeated rows count as often as they
    occur, ids are not looked at, other columns are ignored; texts of any length are taken
    whole. Ties in score and count are broken by the phrase, so ranks are always the same.
    A table without candidates, such as an empty one, gives no rows.
    """
    often, total = phrase_counts(docs, budget)
    candidates = often.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    left = often.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = often.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", F.expr(SCORE))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = candidates.filter("size > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inside = (
        inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
        .select("lang", _part(F.col("at"), F.col("k")).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    covered = F.expr(f"CAST(longer AS DECIMAL(19,0)) * 100 >= CAST(a AS DECIMAL(19,0)) * {SHARE}")
    free = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | ~covered)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = free.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def query(spark, sf_dir):
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, generate_subscripts(p, 1) AS piece, unnest(p) AS words FROM (
    SELECT doc_id, lang, regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS p FROM documents)),
lists AS (SELECT lang, regexp_extract_all(words, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS phrase, size FROM (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists), range(1, 5) AS s(size)
  WHERE i + size - 1 <= len(w)),
counts AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
candidates AS (SELECT * FROM often WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
    ((2000000::HUGEINT * c.f) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS longer FROM (
    SELECT *, unnest(range(1, size - k + 2)) AS i FROM (
      SELECT *, unnest(range(2, size)) AS k FROM candidates WHERE size > 2)) GROUP BY ALL),
free AS (
  SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM free)
JOIN totals USING (lang) WHERE rank <= 2000
"""
