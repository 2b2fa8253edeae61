"""N-gram Jaccard join with prefix trees.

1. Every text becomes its set of hashed word n-grams. The hash range is cut into more parts
   than two sets that link can differ in, so two such sets agree on a whole part; each set
   gives a signature for each of its parts. How many parts depends on the size level; a set
   near the end of a level also signs for the next one. Parts of few n-grams are left out.
2. Sets with a common signature are joined to the smallest id there, never pair by pair: sets
   that may link are members of one leader. Each set also has a histogram of its hashes, which
   bounds the difference of two sets from below; of a leader's members only those stay
   connected that the bound allows. Larger sets have more buckets, as the bound says little
   where a bucket holds many hashes. Leaders with more than MEMBERS keep all their edges. The
   connected components of the edges are the blocks inside which links can lie.
3. A block's sets are put into a prefix tree and searched; see ``prefix_tree``. A block above
   TREE_TOKENS is dealt over several trees: each is searched for itself, then the anchors of
   its largest groups are searched for in every tree, then whatever is still outside the
   largest group. So no task holds more than two trees, and no link is lost.
4. Components of the links, with exact copies attached, are the result.

Copies in one input partition sign once, and copies anywhere meet again by the digest of
their set, so a large group of copies costs little more than one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import documents, runs_of, written
from orgkin.llm.components import connected_components
from orgkin.llm.prefix_tree import PrefixTree

WORDS = 4
PERCENT = 85
LEVEL_RATIO = 1.6
TREE_TOKENS = 1_000_000  # n-grams in one tree, about 30 MB
MEMBERS = 4096  # sets of one leader that are compared by their histograms in one task
BUCKETS = 256  # of the smallest histogram, one byte each
PER_BUCKET = 4  # hashes in a bucket, about, of sets that need more buckets
MOST_BUCKETS = 1 << 14  # a larger set's buckets hold more: its bound is weaker, but holds
COMPARED = 1 << 24  # bytes of histograms that are compared at once
ANCHORS = 16  # largest groups of a tree that are searched for in all trees of the block
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + np.uint64((salt * int(MIX[0])) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text.

    Only A-Z is lowered. A text with fewer words has its whole sequence as the one n-gram.
    """
    split = [(t or "").encode().lower().split() for t in texts]
    flat = [w for ws in split for w in ws]
    if not flat:
        return [np.zeros(0, np.uint64) for _ in split]
    hashed = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    powers = [int(MIX[0]) ** (k + 1) % 2**64 for k in range(n)]
    out, at = [], 0
    for ws in split:
        own = hashed[at: at + len(ws)]
        at += len(ws)
        length = min(n, len(ws))
        if not length:
            out.append(np.zeros(0, np.uint64))
            continue
        end = len(own) - length + 1
        total = own[:end] * np.uint64(powers[0])
        for k in range(1, length):
            total = total + own[k: k + end] * np.uint64(powers[k])
        out.append(np.unique(_mixed(total, length)))
    return out


class Signatures:
    """Signatures such that two sets that link have one in common."""

    def __init__(self, percent: int, longest: int = 1 << 40):
        self.percent = percent
        self.lows = [1]
        while self.lows[-1] < longest:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * LEVEL_RATIO)))

    def parts(self, level: int) -> tuple[int, int]:
        """Parts of a level, and how many of them a set may leave out: at least one more than
        that is equal in both sets."""
        longest = self.lows[level + 1] - 1
        differences = 2 * longest * (100 - self.percent) // (100 + self.percent)
        spare = 2 + differences // 3
        return (differences + 1 + spare if differences else 0), spare

    def of(self, tokens: np.ndarray) -> np.ndarray:
        size = len(tokens)
        if not size:
            return np.zeros(0, np.int64)
        level = int(np.searchsorted(self.lows, size, "right")) - 1
        levels = [level]
        if size * 100 >= self.percent * self.lows[level + 1]:
            levels.append(level + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(tokens, 7))])
        out = []
        for at in levels:
            parts, spare = self.parts(at)
            if not parts:
                continue  # only equal sets link, and those meet by their digest
            part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
            sums = total[cuts[1:]] - total[cuts[:-1]]
            keys = _mixed(sums + np.arange(parts, dtype=np.uint64) * MIX[0], 100 + at)
            # Small parts say little and meet by chance, so those below a size are left out,
            # the largest size that leaves out no more than the spare ones. Of the parts that
            # are equal in two sets, both leave out what the one with the larger size does.
            sizes = cuts[1:] - cuts[:-1]
            least = int(np.sort(sizes)[spare])
            out.append(keys[sizes >= least])
        return (np.concatenate(out) if out else np.zeros(0, np.uint64)).view(np.int64)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    pair = np.array([_mixed(tokens, 11).sum(dtype=np.uint64), _mixed(tokens, 13).sum(dtype=np.uint64)])
    return tuple(pair.view(np.int64).tolist())


def buckets(size: int) -> int:
    """Buckets of the histogram of a set: a power of two."""
    most = BUCKETS
    while most * PER_BUCKET < size and most < MOST_BUCKETS:
        most *= 2
    return most


def histogram(tokens: np.ndarray, width: int = BUCKETS) -> np.ndarray:
    """How many of the hashes fall into each bucket, modulo 256."""
    return np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8)


def _folded(counts: np.ndarray, width: int) -> np.ndarray:
    """Histograms, one a row, with fewer buckets."""
    return counts.reshape(len(counts), -1, width).sum(axis=1, dtype=np.uint8)


def may_link(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the other sets are not ruled out by the histograms: the counts of two sets
    differ by no more than their symmetric difference, also modulo 256."""
    off = np.abs((others - one).view(np.int8)).view(np.uint8).sum(axis=1, dtype=np.int64)
    return off * (100 + percent) <= (100 - percent) * (sizes + size)


def _connected(histograms: list[np.ndarray], sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that connect whatever ``may_link`` connects, by the histograms of fewest buckets and
    then by those of the most that both have: each set is visited once and takes those that
    nobody has taken."""
    widths = np.array([len(h) for h in histograms])
    tables, rows = {}, {}  # by width: the histograms of that width and of twice it, and their places
    for width in {BUCKETS, *widths.tolist(), *(widths // 2).tolist()} - {BUCKETS // 2}:
        some = np.flatnonzero((widths == width) | (widths == 2 * width) | (width == BUCKETS))
        tables[width] = np.concatenate([_folded(histograms[i][None], width) for i in some])
        rows[width] = np.full(len(sizes), -1)
        rows[width][some] = np.arange(len(some))

    def near(at: int, free: np.ndarray, width: int) -> np.ndarray:
        table, place = tables[width], rows[width]
        step = max(1, COMPARED // width)
        return np.concatenate([
            may_link(table[place[at]], sizes[at], table[place[some]], sizes[some], percent)
            for some in (free[k: k + step] for k in range(0, len(free), step))
        ])

    free, edges, todo = np.arange(len(sizes)), [], []
    while len(free):
        if not todo:
            todo, free = [free[0]], free[1:]
            continue
        at = todo.pop()
        found = near(at, free, BUCKETS)
        common = np.minimum(widths[free], widths[at])
        finer = found & (common > BUCKETS) & (np.maximum(widths[free], widths[at]) <= 2 * common)
        for width in np.unique(common[finer]).tolist():
            some = np.flatnonzero(finer & (common == width))
            found[some] = near(at, free[some], width)
        todo.extend(free[found])
        edges.extend((int(at), int(x)) for x in free[found])
        free = free[~found]
    return edges


SIGNED = "doc_id long, n long, h1 long, h2 long, keys array<long>, counts binary"
AT_ONCE = 4_000_000  # characters of texts that are hashed together


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= AT_ONCE or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start: i + 1]
                start, size = i + 1, 0


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    def sign(batches):
        signatures = Signatures(percent)
        seen = set()
        for batch, texts in _text_batches(batches):
            sizes, h1, h2, keys, counts = [], [], [], [], []
            for tokens in shingle_sets(texts, n):
                a, b = _digest(tokens)
                sizes.append(len(tokens))
                h1.append(a)
                h2.append(b)
                new = (a, b) not in seen
                seen.add((a, b))
                keys.append(signatures.of(tokens) if new else np.zeros(0, np.int64))
                counts.append(histogram(tokens, buckets(len(tokens))).tobytes() if len(keys[-1]) else None)
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
                 pa.array(counts, pa.binary())],
                ["doc_id", "n", "h1", "h2", "keys", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, SIGNED)


def _possible(edges: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """``doc_id, leader`` -> ``a, b``: edges that still connect every two members of a leader
    that may link."""
    def prune(batches):
        for group in runs_of(batches, "leader"):
            ids, sizes = group.column("doc_id").to_numpy(), group.column("n").to_numpy()
            counts = [np.frombuffer(x, np.uint8) for x in group.column("counts").to_pylist()]
            found = _connected(counts, sizes, percent)
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    edges = written(edges, "jaccard-edges")
    sizes = edges.groupBy("leader").agg(F.count(F.lit(1)).alias("_n"))
    few = sizes.filter(F.col("_n") < MEMBERS).select("leader")
    many = sizes.filter(F.col("_n") >= MEMBERS).select("leader")
    small = edges.join(few, "leader", "left_semi").unionByName(
        few.select("leader", F.col("leader").alias("doc_id"))
    )
    shapes = signed.filter(F.col("counts").isNotNull()).select("doc_id", "n", "counts")
    dealt = small.join(shapes, "doc_id").select("leader", "doc_id", "n", "counts").repartition("leader")
    kept = dealt.sortWithinPartitions("leader").mapInArrow(prune, "a long, b long")
    whole = edges.join(many, "leader", "left_semi")
    return kept.unionByName(whole.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")))


def _searched(rows: DataFrame, n: int, percent: int, *keys: str) -> DataFrame:
    """Links ``a, b`` found in the tree of each group: rows ``doc_id, text, grp, probe``."""
    def search(batches):
        for group in runs_of(batches, *keys):
            ids, at = np.unique(group.column("doc_id").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            probe = group.column("probe").to_numpy(zero_copy_only=False)
            flagged = np.isin(ids, group.column("doc_id").to_numpy()[probe])
            texts = group.column("text")
            sets = [shingle_sets([texts[int(i)].as_py()], n)[0] for i in at]
            links = PrefixTree(sets).links(group.column("grp").to_numpy()[at], flagged, percent)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[list(a)]), pa.array(ids[list(b)])], ["a", "b"]
                )

    dealt = rows.select(*keys, "doc_id", "text", "grp", "probe").repartition(*keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(search, "a long, b long")


def _open_blocks(places: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, block, tree, grp`` of the blocks that the links leave in several groups."""
    nodes = connected_components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    now = places.join(nodes, "doc_id", "left").withColumn("grp", F.coalesce("grp", "doc_id"))
    apart = now.groupBy("block").agg(F.min("grp").alias("l"), F.max("grp").alias("h")).filter("l < h")
    return written(now.join(apart.select("block"), "block", "left_semi"), "jaccard-open")


def _split_links(
    texts: DataFrame, places: DataFrame, trees: DataFrame, links: DataFrame, n: int, percent: int
) -> DataFrame:
    """All links with those between the trees of blocks that have several (``trees``)."""
    every = trees.select("block", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"))
    found = texts.select("doc_id", "text")
    yes, no = F.lit(True).alias("probe"), F.lit(False).alias("probe")
    now = _open_blocks(places.join(trees.select("block"), "block", "left_semi"), links)
    if now.isEmpty():
        return links
    sizes = now.groupBy("block", "grp").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.withColumn(
        "_at", F.row_number().over(W.partitionBy("block").orderBy(F.desc("_n"), "grp"))
    ).filter(F.col("_at") <= ANCHORS)
    anchors = now.join(largest.select(F.col("grp").alias("doc_id")), "doc_id", "left_semi")
    sent = anchors.drop("tree").join(every, "block").select("block", "tree", "doc_id", "grp", yes)
    rows = now.select("block", "tree", "doc_id", "grp", no).unionByName(sent).join(found, "doc_id")
    links = written(links.unionByName(_searched(rows, n, percent, "block", "tree")), "jaccard-links")

    now = _open_blocks(now.drop("grp"), links)
    if now.isEmpty():
        return links
    sizes = now.groupBy("block", "grp").agg(F.count(F.lit(1)).alias("_n"))
    top = sizes.groupBy("block").agg(F.max_by("grp", F.struct("_n", "grp")).alias("top"))
    outside = now.join(top, "block").filter(F.col("grp") != F.col("top")).drop("top")
    lengths = texts.select("doc_id", F.length("text").alias("_chars"))
    chunks = outside.join(lengths, "doc_id").groupBy("block").agg(
        F.ceil(F.sum("_chars") / (5 * TREE_TOKENS)).alias("chunks")
    )
    left = now.join(chunks, "block").select(
        "block", "tree", "doc_id", "grp", no, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    right = outside.drop("tree").join(chunks, "block").join(every, "block").select(
        "block", "tree", "doc_id", "grp", yes, F.pmod(F.xxhash64("doc_id"), F.col("chunks")).alias("chunk")
    )
    rows = left.unionByName(right).join(found, "doc_id")
    return links.unionByName(_searched(rows, n, percent, "block", "tree", "chunk"))


def jaccard_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for each id, and one for each row
    without an id, which links with nothing (component null).

    Two documents link when ``100 * shared >= percent * all`` n-grams; a component is named
    by its smallest id. Null, empty and blank texts have no n-gram and link with nothing. Rows
    that share an id are one document, of which one row is compared; the largest set's size
    is given. Other columns
    are ignored, whatever their names; an empty table gives no rows.
    """
    signed = written(_signed(docs, n, percent), "jaccard-signed")
    filled = signed.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = filled.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("first"))
    members = written(
        filled.select("doc_id", "n", "h1", "h2").join(classes, ["n", "h1", "h2"])
        .select("doc_id", "n", "first").distinct(), "jaccard-members",
    )
    keys = filled.select("doc_id", F.explode("keys").alias("key"))
    meets = keys.withColumn("leader", F.min("doc_id").over(W.partitionBy("key")))
    edges = meets.filter("doc_id != leader").select("doc_id", "leader").distinct()
    firsts = members.select("doc_id", "first")
    candidates = (
        _possible(edges, filled, percent)
        .join(firsts.select(F.col("doc_id").alias("a"), F.col("first").alias("_a")), "a")
        .join(firsts.select(F.col("doc_id").alias("b"), F.col("first").alias("_b")), "b")
        .select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    )
    blocks = connected_components(candidates).select(
        F.col("node").alias("doc_id"), F.col("component").alias("block")
    )
    sized = blocks.join(members.filter("doc_id = first").select("doc_id", "n"), "doc_id")
    trees = written(
        sized.groupBy("block").agg(F.ceil(F.sum("n") / TREE_TOKENS).alias("trees")), "jaccard-trees"
    )
    places = blocks.join(trees, "block").select(
        "doc_id", "block", F.pmod(F.xxhash64("doc_id"), F.col("trees")).alias("tree")
    )
    placed = written(places, "jaccard-places")
    texts = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(placed, "doc_id"),
        "jaccard-texts",
    )
    own = texts.withColumns({"grp": F.col("doc_id"), "probe": F.lit(True)})
    links = _searched(own, n, percent, "block", "tree")
    split = trees.filter("trees > 1")
    if not split.isEmpty():
        links = written(links, "jaccard-links")
        links = _split_links(texts, placed, split, links, n, percent)
    same = members.filter("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    groups = connected_components(links.unionByName(same))
    known = signed.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("n").alias("n"))
    joined = known.join(groups, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
    nameless = signed.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return joined.unionByName(nameless)


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id
    stays, with its own columns. Rows without an id all stay; of rows that share an id one
    stays."""
    firsts = (
        jaccard_components(docs, n, percent)
        .filter("doc_id = component_id").select(F.col("doc_id").alias("_first_id"))
    )
    named = docs.join(firsts, docs["doc_id"] == F.col("_first_id"), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))


def query(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))
