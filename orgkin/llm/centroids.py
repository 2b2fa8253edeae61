"""Centroid clustering in whole numbers; the nearest centroid is found by the threshold algorithm.

For every dimension the centroids are kept in a list sorted by that component. A vector walks
each list outwards from its own value, always to the nearer side. A centroid met in any list
is measured exactly. The differences at the frontiers of all lists, squared and summed, bound
the distance of every centroid not met yet, so the walk ends when that sum strictly exceeds
the best distance; at equality a smaller number could still be met. All vectors of a batch
take their steps together, those that are done drop out.

Sums and distances are whole numbers. Each task adds up its vectors by centroid; what reaches
the driver is one sum per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import documents, written

CLUSTERS = 16
ROUNDS = 3
LENGTH = 64
SCALE = 64
LARGEST = 1 << 62  # components from here on have no distance that a long can hold
EXACT = 1 << 27  # below it 64 squared differences of longs fit a long
ROWS = 4_096  # vectors that walk together


def whole_vectors(vectors: DataFrame, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: vectors of that length without null or non-finite components, as whole
    numbers. Vectors with a component of LARGEST or more, scaled, take no part."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = rows.filter(
        v.isNotNull() & (F.size(v) == length)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float(LARGEST)))
    )
    return good.select("vec_id", F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


class SortedLists:
    """The centroids, sorted by each of their components."""

    def __init__(self, centroids: list[list[int]]):
        most = max((abs(x) for c in centroids for x in c), default=0)
        self.small = most < EXACT
        self.points = np.array(centroids, np.int64 if self.small else object).reshape(len(centroids), -1)
        self.order = np.argsort(self.points, axis=0, kind="stable")
        self.values = np.take_along_axis(self.points, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid, ties to the smaller
        number. Values that could pass 64 bits are computed as Python integers."""
        if not self.small or len(vectors) and np.abs(vectors).max() >= EXACT:
            vectors, points, values = vectors.astype(object), self.points.astype(object), self.values.astype(object)
        else:
            points, values = self.points, self.values
        k, dims = points.shape
        n = len(vectors)
        best = np.zeros(n, vectors.dtype)
        number = np.full(n, k, np.int64)
        met = np.zeros((n, k), bool)
        dim = np.arange(dims)
        # the next centroid to the left and to the right of the vector's value in each list
        right = (values[None, :, :] < vectors[:, None, :]).sum(1)
        left = right - 1
        walking = np.arange(n)
        while len(walking):
            v, lo, hi = vectors[walking], left[walking], right[walking]
            more_left, more_right = lo >= 0, hi < k
            to_left = np.abs(v - values[np.maximum(lo, 0), dim])
            to_right = np.abs(v - values[np.minimum(hi, k - 1), dim])
            go_left = more_left & (~more_right | (to_left <= to_right))
            frontier = np.where(go_left, to_left, to_right)
            # before the first step nothing is measured, so nothing can be exceeded
            open_ = (number[walking] == k) | ((frontier * frontier).sum(1) <= best[walking])
            open_ &= ~met[walking].all(1)
            walking, lo, hi, go_left = walking[open_], lo[open_], hi[open_], go_left[open_]
            if not len(walking):
                break
            found = self.order[np.where(go_left, lo, hi), dim]
            left[walking] = lo - go_left
            right[walking] = hi + ~go_left
            new = np.zeros((len(walking), k), bool)
            new[np.arange(len(walking))[:, None], found] = True
            new &= ~met[walking]
            met[walking] |= new
            for c in range(k):
                rows = walking[new[:, c]]
                if len(rows):
                    off = vectors[rows] - points[c]
                    distance = (off * off).sum(1)
                    better = (number[rows] == k) | (distance < best[rows]) | (
                        (distance == best[rows]) & (c < number[rows])
                    )
                    number[rows[better]] = c
                    best[rows[better]] = distance[better]
        return number, best


def _rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _sums(lists: SortedLists, length: int):
    """Vectors -> per task and centroid: how many vectors, and their sum as decimal texts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * len(lists.points)
        total = np.zeros((len(lists.points), length), object)
        for _, v in _rows(batches, length):
            number, _ = lists.nearest(v)
            # parts of 32 bits cannot overflow within a batch
            high, low = v >> 32, v & 0xFFFFFFFF
            for c in np.unique(number):
                own = number == c
                count[c] += int(own.sum())
                total[c] += high[own].sum(0).astype(object) * (1 << 32) + low[own].sum(0).astype(object)
        there = [c for c, n in enumerate(count) if n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(there, pa.int32()), pa.array([count[c] for c in there], pa.int64()),
                pa.array([[str(x) for x in total[c]] for c in there], pa.list_(pa.string())),
            ],
            ["cluster", "n", "total"],
        )

    return made


def _assigned(lists: SortedLists, length: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _rows(batches, length):
            number, best = lists.nearest(v)
            distance = [int(d) if d < 1 << 63 else None for d in best]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return made


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every vector, and the centroids after ``rounds`` rounds.

    Vectors with nulls, non-finite components or another length take no part. Ids may repeat
    or be null (hashed as an empty text); each row is a vector of its own, and rows alike start
    as centroids alike, of which the smaller number attracts. Fewer than ``k`` vectors make
    fewer centroids; an empty table gives no rows. A distance beyond 64 bits is null. Other
    columns are ignored.
    """
    rows = written(whole_vectors(vectors, length, scale), "whole-vectors")
    mark = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    starts = rows.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    centroids = [list(r.v) for r in starts]
    sums = "cluster int, n long, total array<string>"
    for _ in range(rounds if centroids else 0):
        found = rows.mapInArrow(_sums(SortedLists(centroids), length), sums)
        parts = found.select("cluster", "n", F.posexplode("total").alias("at", "part")).groupBy("cluster", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
        )
        for r in parts.collect():  # k * length rows
            centroids[r["cluster"]][r["at"]] = int(r["total"]) // r["n"]
    schema = "vec_id long, cluster int, distance long"
    if not centroids:
        return rows.sparkSession.createDataFrame([], schema), centroids
    return rows.mapInArrow(_assigned(SortedLists(centroids), length), schema), centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """Every vector with its ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``; see ``cluster``. An inertia beyond 64 bits is null."""
    found, centroids = cluster(vectors, **options)
    found = written(found, "clusters")
    own = {
        r["cluster"]: int(r["own"]) if r["own"] is not None else 0
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    }
    inertia = sum(own.values())

    def fits(x: int) -> int | None:
        return x if x < 1 << 63 else None

    totals = found.sparkSession.createDataFrame(  # as many rows as centroids
        [
            (c, fits(own[c]), fits(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c in sorted(own)
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def query(spark, sf_dir):
    return clusters(documents(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    ctes = [f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {LENGTH}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {LENGTH})""",
            f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v)::INT - 1 AS cluster, v AS c
  FROM kept QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) <= {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} AS (
  SELECT vec_id, v, cluster, distance FROM (
    SELECT vec_id, v, cluster,
      list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM kept, c{i})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if i < ROUNDS:
            ctes.append(f"""s{i} AS (
  SELECT cluster, i, sum(x::HUGEINT) AS s, count(*) AS n FROM (
    SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY cluster, i),
m{i} AS (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""


ORACLE = _oracle()
