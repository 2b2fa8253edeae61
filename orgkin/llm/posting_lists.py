"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

Vectors get one more component, so that the nearest by distance is the one with the largest
inner product. Centroids come from a bounded sample, halved again and again at the median, so
lists are balanced. A vector goes to every list whose centroid is almost as near as its
nearest one, but to one of several centroids that lie together. Centroids are searched by
best-first walks over a graph of their neighbours, held in memory: at most MOST_LISTS of
them. A query reads the lists whose distance is within a ratio of its nearest one.

Equal vectors are indexed once and searched for once; their ids come back at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import documents, runs_of, written

TOP = 20
SAMPLE = 65_536  # vectors that the centroids are fitted on, by hash of their content
LIST_SIZE = 256  # vectors aimed at for a list
MOST_LISTS = 16_384  # centroids in memory, about 5 MB at 64 components
DEGREE = 24
BEAM = 160  # centroids kept while a query walks
NARROW = 32  # and while a vector is placed
COPIES = 4
SPREAD = 0.25  # of lists nearer to each other than this part of its distance it joins one
BOUNDARY = 1.1  # a vector joins lists up to this times its nearest centroid's distance
READ_RATIO = 1.1  # a query reads lists up to this times its nearest centroid's distance
READ_LEAST = 12
BLOCK = 4_096  # vectors of a list that are scored together
STEP = 512  # queries that are scored together
HELD = 2_000_000  # neighbours that a task holds before it passes some on


def _finite(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors with an id and finite components that are not all zero."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors with finite components that are not all zero, of the commonest
    length; the others take no part."""
    good = _finite(vectors)
    length = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return good.filter(F.size("v") == (length.d if length else 0))


class _Best:
    """The best ``k`` neighbours of each query among those that a task has met."""

    def __init__(self, k: int):
        self.k, self.held, self.n = k, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.held.append(columns)
        self.n += len(columns[0])

    def cut(self) -> None:
        if not self.held:
            return
        q, first, score = (np.concatenate(c) for c in zip(*self.held, strict=True))
        order = np.lexsort((first, -score, q))
        q, first, score = q[order], first[order], score[order]
        # a vector that stands in several lists is met several times
        new = np.append(True, (q[1:] != q[:-1]) | (first[1:] != first[:-1]))
        q, first, score = q[new], first[new], score[new]
        starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        kept = place < self.k
        self.held, self.n = [(q[kept], first[kept], score[kept])], int(kept.sum())

    def out(self) -> list[pa.RecordBatch]:
        held, self.held, self.n = self.held, [], 0
        return [
            pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "first", "score"]) for columns in held
        ]


def _halved(x: np.ndarray, lists: int, rng) -> list[np.ndarray]:
    """Row numbers of ``lists`` parts of nearly equal size (a power of two of them)."""
    parts = [np.arange(len(x))]
    while len(parts) < lists:
        new = []
        for rows in parts:
            own = x[rows]
            a, b = own[rng.integers(len(own))], own[rng.integers(len(own))]
            for _ in range(4):
                side = ((own - a) ** 2).sum(1) - ((own - b) ** 2).sum(1)
                half = np.argsort(side, kind="stable")
                a, b = own[half[: len(half) // 2]].mean(0), own[half[len(half) // 2:]].mean(0)
            new += [rows[half[: len(half) // 2]], rows[half[len(half) // 2:]]]
        parts = new
    return parts


class CentroidGraph:
    """Centroids with links to their neighbours, and walks over them for many points."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids.astype(np.float32)
        self.norm = (self.c**2).sum(1)
        n, k = len(self.c), min(DEGREE, max(len(self.c) - 1, 1))
        self.near = np.zeros((n, k), np.int64)
        for at in range(0, n, 1024):
            d = self.norm - 2 * self.c[at: at + 1024] @ self.c.T
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            self.near[at: at + 1024] = np.argsort(d, 1)[:, :k] if n > 1 else 0
        # Parts are in the order of the halving, so these are spread over the whole space.
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 64)).astype(np.int64))

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.norm[at] - 2 * np.einsum("qd,qkd->qk", x, self.c[at])

    def search(self, x: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``k`` near centroids of each point, nearest first, with squared distances.

        All points walk together: each opens its nearest unopened centroid and takes in the
        neighbours, until what it keeps is all opened.
        """
        x = x.astype(np.float32)
        q, beam = len(x), min(beam, len(self.c))
        found = np.tile(self.entries, (q, 1))
        d = self._distance(x, found)
        opened = np.zeros(found.shape, bool)
        rows = np.arange(q)[:, None]
        for _ in range(len(self.c)):
            waiting = np.where(opened, np.inf, d)
            step = np.argsort(waiting, 1)[:, : max(4, beam // 16)]  # a few at once
            live = np.isfinite(np.take_along_axis(waiting, step[:, :1], 1)[:, 0])
            if not live.any():
                break
            np.put_along_axis(opened, step, True, 1)
            new = self.near[np.take_along_axis(found, step, 1)].reshape(q, -1)
            found = np.concatenate([found, new], 1)
            d = np.concatenate([d, self._distance(x, new)], 1)
            opened = np.concatenate([opened, np.zeros(new.shape, bool)], 1)
            # one entry of each centroid stays, an opened one if there is one
            order = np.lexsort((~opened, found), axis=1)
            found, d, opened = found[rows, order], d[rows, order], opened[rows, order]
            again = np.zeros(found.shape, bool)
            again[:, 1:] = found[:, 1:] == found[:, :-1]
            d = np.where(again, np.inf, d)
            opened |= again
            order = np.argsort(d, 1, kind="stable")[:, :beam]
            found, d, opened = found[rows, order], d[rows, order], opened[rows, order]
        order = np.argsort(d, 1, kind="stable")[:, :k]
        d2 = np.take_along_axis(d, order, 1) + (x**2).sum(1)[:, None]
        return np.take_along_axis(found, order, 1), np.maximum(d2, 0)

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each vector is kept in."""
        found, d2 = self.search(x, COPIES * 3, NARROW)
        out = []
        for at, far in zip(found, d2, strict=True):
            chosen = [at[0]]
            for c, d in zip(at[1:], far[1:], strict=True):
                if d > far[0] * BOUNDARY**2 or len(chosen) == COPIES or not np.isfinite(d):
                    break
                if all(((self.c[c] - self.c[o]) ** 2).sum() > d * SPREAD**2 for o in chosen):
                    chosen.append(c)
            out.append(np.array(chosen))
        return out

    def read_by(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each query reads."""
        found, d2 = self.search(x, BEAM, BEAM)
        keep = np.isfinite(d2) & ((d2 <= d2[:, :1] * READ_RATIO**2) | (np.arange(found.shape[1]) < READ_LEAST))
        return [at[k] for at, k in zip(found, keep, strict=True)]


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def fit(distinct: DataFrame) -> tuple[CentroidGraph, float] | None:
    """Centroids and the largest squared length, from a bounded sample; None if empty."""
    stats = distinct.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b)).alias("m")
    ).first()
    if not stats.n:
        return None
    sample = distinct.select("v", F.xxhash64("v").alias("h"))
    share = SAMPLE / stats.n
    if share < 1:  # a margin over the sample, cut by the limit below
        sample = sample.filter(F.pmod("h", F.lit(1 << 20)) < int(min(1.0, share * 1.2) * (1 << 20)))
    x = np.array([r.v for r in sample.orderBy("h").limit(SAMPLE).collect()])
    x = np.hstack([x, np.sqrt(np.maximum(stats.m - (x**2).sum(1), 0))[:, None]])
    lists = 1
    while lists * LIST_SIZE < stats.n and lists < MOST_LISTS and lists * 4 <= len(x):
        lists *= 2
    parts = _halved(x, lists, np.random.default_rng(1))
    return CentroidGraph(np.array([x[p].mean(0) for p in parts])), float(stats.m)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors found with the largest inner
    product with each query, other than its own id; ties go to the smaller id.

    Both tables have ``vec_id, embedding``. Scores are exact, in double precision. Null,
    zero and non-finite vectors and those of another length take no part; of rows that share
    an id and a vector one counts. Other columns are ignored. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    base = written(usable(vectors).distinct(), "ann-vectors")
    length = base.select(F.size("v").alias("d")).first()
    asked = _finite(queries).filter(F.size("v") == (length.d if length else 0)).withColumnRenamed("vec_id", "query_id")
    groups = written(base.groupBy("v").agg(F.min("vec_id").alias("first")), "ann-distinct")
    fitted = fit(groups)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(fitted)

    def listed(reads: bool):
        def place(batches):
            graph, longest = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, STEP):
                    part = batch.slice(at, STEP)
                    x = _matrix(part.column("v"))
                    tail = np.zeros(len(x)) if reads else np.sqrt(np.maximum(longest - (x**2).sum(1), 0))
                    x = np.hstack([x, tail[:, None]])
                    lists = graph.read_by(x) if reads else graph.lists_of(x)
                    rows = np.repeat(np.arange(len(x)), [len(y) for y in lists])
                    out = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(lists)), out.column("id"), out.column("v")], ["list", "id", "v"]
                    )
        return place

    form = "list long, id long, v array<double>"
    kept = groups.select(F.col("first").alias("id"), "v").mapInArrow(listed(False), form)
    kept = written(kept, "ann-lists")
    ask = written(asked.groupBy("v").agg(F.min("query_id").alias("id")), "ann-queries")
    reads = ask.select("id", "v").mapInArrow(listed(True), form)
    blocks = kept.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    left = kept.join(blocks, "list").select(
        "list", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "v", F.lit(False).alias("asks")
    )
    right = reads.join(blocks, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v", F.lit(True).alias("asks")
    )

    def scored(batches):
        best = _Best(k + 1)
        for group in runs_of(batches, "list", "block"):
            asks = group.column("asks").to_numpy(zero_copy_only=False)
            ids = group.column("id").to_numpy()
            if asks.all() or not asks.any():
                continue
            x = _matrix(group.column("v"))
            mine, points = np.flatnonzero(asks), np.flatnonzero(~asks)
            for at in range(0, len(mine), STEP):
                q = mine[at: at + STEP]
                s = x[q] @ x[points].T
                top = np.argpartition(-s, min(k, len(points) - 1), 1)[:, : k + 1]
                row = np.repeat(np.arange(len(q)), top.shape[1])
                col = top.ravel()
                best.add(ids[q][row], ids[points][col], (x[q][row] * x[points][col]).sum(1))
                if best.n > HELD:
                    best.cut()
                    if 2 * best.n > HELD:  # of many queries
                        yield from best.out()
        best.cut()
        yield from best.out()

    dealt = left.unionByName(right).repartition("list", "block").sortWithinPartitions("list", "block")
    hits = dealt.mapInArrow(scored, "q long, first long, score double").distinct()
    order = [F.desc("score"), F.asc("first")]
    best = hits.withColumn("at", F.row_number().over(W.partitionBy("q").orderBy(*order))).filter(F.col("at") <= k + 1)
    # Back to ids: of each found vector as many ids as can be needed, of each query all.
    named = base.join(groups, "v").withColumn(
        "at", F.row_number().over(W.partitionBy("first").orderBy("vec_id"))
    ).filter(F.col("at") <= k + 1).select("first", "vec_id")
    ids = asked.join(ask, "v").select(F.col("id").alias("q"), "query_id")
    pairs = best.select("q", "first", "score").join(named, "first").join(ids, "q").filter("vec_id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def query(spark, sf_dir):
    vectors = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    good = usable(vectors).withColumnRenamed("v", "embedding")
    return nearest(vectors, good.filter("vec_id % 20 = 0"))
