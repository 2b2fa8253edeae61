"""Approximate nearest neighbours with payload filters, over hash tables of random projections.

``hash_rows`` gives every index point one bucket in each table; the rows hold no vectors. A search
walks each query's buckets from the nearest on, counting only rows that pass its filter, so a
narrow filter reaches further. Points met in several buckets are scored exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from orgkin.functions.numeric import round_exact
from orgkin.functions.scoring import cosine_raw, norm  # noqa: F401
from orgkin.operators.keyed import spread, top_per_key
from orgkin.operators.vectors import (
    BLOCK_BYTES, CELLS, PAYLOAD, RANK_DIGITS, _candidate_schema, _Scorer, asked_queries, search_batch,
)
from orgkin.session import scratch_dir
from orgkin.sources.tables import write_stage

PROBE_BITS = 10  # a query reaches the 2^10 buckets of a table that its surest bits agree with
ANY = "*"  # no filter; payloads never hold it
_COST_DIGITS = 9
OPEN_CELLS = 1 << 26  # places by queries that a task holds
MOST_SIZES = 1 << 18  # sizes of buckets that are broadcast; more are shuffled


@dataclass(frozen=True)
class HashTables:
    """Shape of the tables. 2^``bits`` buckets should hold some hundred points each.

    ``reads``: a query walks on until its buckets hold that many rows a passing point;
    ``floor``: and until they hold this many rows; ``agree``: in how many tables a point has to
    be met to be scored; ``same``: points with one vector and payload that stay in the tables,
    so results of up to ``same`` rows are right however often a vector repeats.
    """

    dimensions: int
    tables: int = 16
    bits: int = 8
    reads: float = 3.0
    floor: int = 2000
    agree: int = 4
    same: int = 100

    def planes(self) -> np.ndarray:
        """Signs of the projections, by a hash of table, bit and component."""
        names = (f"{t}:{b}:{d}" for t in range(self.tables) for b in range(self.bits) for d in range(self.dimensions))
        signs = [1.0 if hashlib.md5(n.encode()).hexdigest()[0] < "8" else -1.0 for n in names]
        return np.array(signs).reshape(self.tables * self.bits, self.dimensions)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vector: str, dimensions: int) -> Column:
    """A vector of the right size with finite components, not all of them zero."""
    value = F.col(vector)
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(value) == dimensions) & fine & F.exists(value, lambda x: x != 0), F.lit(False))


def hash_rows(points: DataFrame, shape: HashTables) -> DataFrame:
    """``bucket_table, bucket, country, entity_status, lei`` of every usable point and table.

    Store them once per index version. Repeated vectors beyond ``shape.same`` of one payload
    can't be among the first ``same`` results and are left out, before any shuffle. Null, zero
    and other-length vectors take no part; an empty index gives no rows.
    """
    planes, powers = shape.planes(), 1 << np.arange(shape.bits, dtype=np.int64)

    def hashed(batches):
        for rows in batches:
            if rows.num_rows:
                vectors = _matrix(rows.column("embedding"))
                set_bits = (vectors @ planes.T > 0).reshape(len(vectors), shape.tables, shape.bits)
                digests = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in vectors]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("lei", "country", "entity_status")),
                     pa.array(digests, pa.binary()), pa.array(list(set_bits @ powers), pa.list_(pa.int64()))],
                    names=["lei", "country", "entity_status", "digest", "buckets"],
                )

    wanted = points.filter(usable("embedding", shape.dimensions)).select("lei", "country", "entity_status", "embedding")
    rows = wanted.mapInArrow(
        hashed, "lei string, country string, entity_status string, digest binary, buckets array<bigint>"
    )
    first = top_per_key(rows, ["digest", "country", "entity_status"], shape.same, F.asc("lei"))
    return first.select(
        "country", "entity_status", "lei", F.posexplode("buckets").alias("bucket_table", "bucket")
    ).select("bucket_table", "bucket", "country", "entity_status", "lei")


def probes(queries: DataFrame, shape: HashTables) -> DataFrame:
    """The buckets in reach of each query; ``cost`` is how far its projections are from them."""
    planes, near = shape.planes(), min(shape.bits, PROBE_BITS)
    subsets = np.arange(1 << near)[:, None] >> np.arange(near) & 1

    def reached(batches):
        for rows in batches:
            ids = rows.column("query_id")
            for i, vector in enumerate(_matrix(rows.column("vector")) if rows.num_rows else ()):
                away = (planes @ vector).reshape(shape.tables, shape.bits) / np.sqrt(vector @ vector)
                own = (away > 0) @ (1 << np.arange(shape.bits, dtype=np.int64))
                loose = np.argsort(np.abs(away), axis=1, kind="stable")[:, :near]
                cost = np.take_along_axis(np.abs(away), loose, 1) @ subsets.T
                flips = (np.int64(1) << loose.astype(np.int64)) @ subsets.T
                tables = np.repeat(np.arange(shape.tables, dtype=np.int32), 1 << near)
                rest = [c for c in rows.schema.names if c not in ("query_id", "vector")]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([i] * len(tables))), *(rows.column(c).take(pa.array([i] * len(tables))) for c in rest),
                     pa.array(tables), pa.array((own[:, None] ^ flips).reshape(-1)),
                     pa.array(np.round(cost, _COST_DIGITS).reshape(-1))],
                    names=["query_id", *rest, "bucket_table", "bucket", "cost"],
                )

    kind = queries.schema["query_id"].dataType.simpleString()
    wanted = queries.filter(usable("vector", shape.dimensions)).select("query_id", "country", "entity_status", "vector")
    return spread(wanted, "query_id").mapInArrow(
        reached, f"query_id {kind}, country string, entity_status string, bucket_table int, bucket bigint, cost double"
    )


def _by_filter(rows: DataFrame) -> DataFrame:
    """Each row under the four filters that let it pass: country and status, each given or not."""
    either = [F.explode(F.array(F.coalesce(c, F.lit("")), F.lit(ANY))).alias(f"by_{c}") for c in ("country", "entity_status")]
    return rows.select("*", either[0]).select("*", either[1])


def _filter_of(queries: DataFrame) -> DataFrame:
    return queries.withColumns({f"by_{c}": F.coalesce(c, F.lit(ANY)) for c in ("country", "entity_status")})


_FILTER = ["by_country", "by_entity_status"]


def _opened(tables: DataFrame, queries: DataFrame, shape: HashTables) -> DataFrame:
    """``query_id, asks``: the places (table and bucket in one number) that each query opens, under its filters."""
    place = ["bucket_table", "bucket"]
    # sizes of the filters that queries ask for are few; probes are many rows that the planner takes for
    # few, so it must not choose to broadcast them through the driver
    wanted = _settled(_filter_of(queries).select(*_FILTER).distinct(), "filters")
    sizes = _by_filter(tables.select(*place, "country", "entity_status")).join(wanted, _FILTER, "left_semi")
    sizes = _settled(sizes.groupBy(*place, *_FILTER).agg(F.count(F.lit(1)).alias("n")), "sizes")
    passing = sizes.filter("bucket_table = 0").groupBy(*_FILTER).agg(F.sum("n").alias("passing"))
    how = "broadcast" if sizes.count() <= MOST_SIZES else "merge"
    asked = _filter_of(probes(queries, shape)).join(sizes.hint(how), [*place, *_FILTER]).join(passing.hint(how), _FILTER)
    walk = W.partitionBy("query_id").orderBy("cost", *place).rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("n").over(walk), F.lit(0))
    line = F.greatest(F.lit(float(shape.floor)), shape.reads * F.col("passing"))
    opened = asked.withColumn("seen", seen).filter(F.col("seen") < line)
    ask = opened.groupBy("query_id", *_FILTER).agg(F.collect_list(_place(shape)).alias("places"))
    return ask.groupBy("query_id").agg(F.collect_list(F.struct(*_FILTER, "places")).alias("asks"))


def _place(shape: HashTables) -> Column:
    return F.col("bucket_table") * F.lit(1 << shape.bits) + F.col("bucket")


def _stands(tables: DataFrame, shape: HashTables) -> DataFrame:
    """``lei, stands``: the places of each key's points, by payload."""
    payload = [F.coalesce(c, F.lit("")).alias(f"by_{c}") for c in ("country", "entity_status")]
    stand = tables.groupBy("lei", *payload).agg(F.collect_list(_place(shape)).alias("places"))
    return stand.groupBy("lei").agg(F.collect_list(F.struct(*_FILTER, "places")).alias("stands"))


class _Places:
    """Rows of (filter, places) lists: flat places in the order of their owners."""

    def __init__(self, lists: pa.Array):
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.start = np.concatenate(([0], np.cumsum(size)))
        rows = dict(zip([*_FILTER, "places"], lists.flatten().flatten(), strict=True))
        self.filters = [rows[c] for c in _FILTER]
        self.size = pc.list_value_length(rows["places"]).to_numpy(zero_copy_only=False)
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.places = rows["places"].flatten().to_numpy(zero_copy_only=False)


class _Meetings:
    """In how many tables the keys of one block are met by the queries of another.

    Counts are made for a range of keys at a time, a byte or four for each query, so what is held
    is bounded by the caller's ranges and by ``OPEN_CELLS``.
    """

    def __init__(self, keys: _Places, asks: pa.Array, agree: int):
        self.keys, self.agree = keys, agree
        mine = _Places(asks)
        self.first = mine.start[:-1]
        self.single = len(mine.size) == len(asks)
        known, code = np.unique(mine.places, return_inverse=True)
        owner = np.repeat(np.arange(len(mine.size)), mine.size)
        most = keys.size.max(initial=0) * np.diff(keys.start).max(initial=0) * np.diff(mine.start).max(initial=0)
        kind = np.uint8 if most * max(1, _most(owner, code, len(known))) < 256 else np.int32
        # a row a place with a count a query, so that a point reads rows; the last row is of places nobody opens
        self.open = np.zeros((len(known) + 1, len(mine.size)), dtype=kind)
        np.add.at(self.open, (code, owner), kind(1))
        at = np.searchsorted(known, keys.places)
        hit = at < len(known)
        hit[hit] = known[at[hit]] == keys.places[hit]
        self.code = np.where(hit, at, len(known))
        self.wanted = []
        for theirs, ours in zip(keys.filters, mine.filters):
            if pc.all(pc.equal(ours, ANY)).as_py() is False:
                names = ours.unique()
                number = pc.index_in(ours, names).to_numpy(zero_copy_only=False)
                anyone = pc.equal(ours, ANY).to_numpy(zero_copy_only=False)
                has = pc.fill_null(pc.index_in(theirs, names), -1).to_numpy(zero_copy_only=False)
                self.wanted.append((has, number, anyone))

    def met(self, lo: int, hi: int) -> np.ndarray:
        """Keys ``lo`` to ``hi`` by queries: whether they are met often enough."""
        first, last = self.keys.start[lo], self.keys.start[hi]
        size, at = self.keys.size[first:last], self.keys.at[first:last]
        count = np.zeros((last - first, self.open.shape[1]), dtype=self.open.dtype)
        for i in range(int(size.max(initial=0))):
            if size.min() > i:
                count += self.open[self.code[at + i]]
            else:
                rows = np.flatnonzero(size > i)
                count[rows] += self.open[self.code[at[rows] + i]]
        for has, number, anyone in self.wanted:
            count *= anyone | (has[first:last, None] == number)
        if last - first > hi - lo:
            count = np.add.reduceat(count, self.keys.start[lo:hi] - first, axis=0)
        if not self.single:
            count = np.add.reduceat(count, self.first, axis=1)
        return count >= self.agree


def _most(owner: np.ndarray, code: np.ndarray, codes: int) -> int:
    """How often a query opens one place at most: more than once only if its id repeats."""
    _, times = np.unique(owner.astype(np.int64) * codes + code, return_counts=True)
    return int(times.max(initial=0))


def _cells(points: DataFrame, queries: DataFrame, shape: HashTables, n_points: int, n_queries: int) -> DataFrame:
    """Every block of points (by ``lei``) with every block of queries (by ``query_id``), as groups ``_p, _q``.

    Rows hold a point or a query; blocks are bounded in bytes.
    """
    reach = shape.tables << min(shape.bits, PROBE_BITS)
    per_points = max(1, BLOCK_BYTES // (8 * (shape.dimensions + shape.tables)))
    per_queries = max(1, BLOCK_BYTES // (8 * (shape.dimensions + reach)))
    per_queries = min(per_queries, max(1, OPEN_CELLS // min(shape.tables << shape.bits, per_queries * reach)))
    cores = points.sparkSession.sparkContext.defaultParallelism
    p = max(1, -(-n_points // per_points))
    q = max(1, -(-n_queries // per_queries), min(n_queries, -(-2 * cores // p)))

    def blocks(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    mine = points.select(
        F.pmod(F.xxhash64("lei"), F.lit(p)).cast("int").alias("_p"), blocks(q).alias("_q"),
        F.struct(*points.columns).alias("point"),
    )
    asked = queries.select(
        blocks(p).alias("_p"), F.pmod(F.xxhash64("query_id"), F.lit(q)).cast("int").alias("_q"),
        F.struct(*queries.columns).alias("query"),
    )
    rows = mine.unionByName(asked, allowMissingColumns=True)
    return rows.repartition(p * q, "_p", "_q").groupBy("_p", "_q")


def _sides(batches: Iterator[pa.RecordBatch]) -> list[pa.Table]:
    """The points of a cell in the order of their keys, and its queries in the order of theirs."""
    rows = pa.Table.from_batches(list(batches))
    out = []
    for side, key in (("point", "lei"), ("query", "query_id")):
        column = rows.column(side)
        mine = column.filter(column.is_valid()).combine_chunks()
        table = pa.Table.from_arrays(mine.flatten(), names=[f.name for f in mine.type])
        order = pc.sort_indices(table, [(key, "ascending")])
        out.append(table.take(order).combine_chunks())
    return out


def _new(column: pa.ChunkedArray) -> np.ndarray:
    """Whether a row of a sorted column begins a key; null is a key of its own."""
    values = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, dtype=bool)


def candidates(tables: DataFrame, queries: DataFrame, shape: HashTables) -> DataFrame:
    """Distinct ``query_id, lei`` worth scoring. ``queries``: as ``asked_queries`` gives them.

    Blocks of queries and of points meet in cells, where the tables that meet are counted, so
    only the results leave a task.
    """
    opened = _settled(_opened(tables, queries, shape), "opened")
    stands = _settled(_stands(tables, shape), "stands")
    agree = min(shape.agree, shape.tables)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, asked = _sides(batches)
        if points.num_rows and asked.num_rows:
            keys, ids = points["lei"].combine_chunks(), asked["query_id"].combine_chunks()
            meetings = _Meetings(_Places(points["stands"].combine_chunks()), asked["asks"].combine_chunks(), agree)
            step = max(1, CELLS // len(meetings.open[0]))
            for lo in range(0, len(keys), step):
                r, q = np.nonzero(meetings.met(lo, min(lo + step, len(keys))))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), keys.take(pa.array(r + lo))], names=["query_id", "lei"])

    kind = opened.schema["query_id"].dataType.simpleString()
    cells = _cells(stands, opened, shape, stands.count(), opened.count())
    return cells.applyInArrow(found, f"query_id {kind}, lei string")


def _settled(df: DataFrame, name: str) -> DataFrame:
    return write_stage(df, scratch_dir(df.sparkSession, name), blanks=True)


def near(points: DataFrame, tables: DataFrame, queries: DataFrame, shape: HashTables, k: int = 10) -> DataFrame:
    """The ``k`` best candidates per query by cosine, in the form of ``search_batch``.

    Candidates are scored in the cell that finds them; a cell passes on the ``k`` best of each
    query and how many it had. A query that meets fewer than ``k`` candidates is searched exactly,
    so no filter, however narrow, costs results. Queries without a usable vector get none.
    """
    if k > shape.same:
        raise ValueError(f"the tables hold {shape.same} points of one vector, too few for {k} results")
    asked = asked_queries(queries).filter(usable("vector", shape.dimensions))
    opened = _opened(tables, asked, shape)
    walking = _settled(asked.select("query_id", "vector").join(opened, "query_id"), "opened")
    whole = points.filter(usable("embedding", shape.dimensions))
    standing = _settled(
        whole.select(*PAYLOAD, "embedding", norm("embedding").alias("norm")).join(_stands(tables, shape), "lei"), "stands"
    )
    agree = min(shape.agree, shape.tables)
    schema = _candidate_schema(walking).add("met", "long")
    arrow = to_arrow_schema(schema)

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, theirs = _sides(batches)
        if not mine.num_rows or not theirs.num_rows:
            return
        begins, ids = _new(mine["lei"]), theirs["query_id"].combine_chunks()
        key = np.cumsum(begins) - 1
        stands = mine["stands"].combine_chunks().filter(pa.array(begins))
        meetings = _Meetings(_Places(stands), theirs["asks"].combine_chunks(), agree)
        counts = np.zeros(len(ids), dtype=np.int64)

        def allowed(part: slice) -> np.ndarray:
            at = key[part]
            met = meetings.met(at[0], at[-1] + 1)[at - at[0]]
            counts[:] += met[begins[part]].sum(axis=0)
            return met.T

        vectors = _matrix(theirs["vector"].combine_chunks())
        scorer = _Scorer(ids, vectors, [None] * len(ids), [None] * len(ids), k, RANK_DIGITS)
        rows = scorer.batch(mine.drop_columns(["stands"]).to_batches()[0], allowed)
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(rows.num_rows, pa.int64())], schema=arrow)
        once = pa.array(np.flatnonzero(_new(theirs["query_id"])))
        empty = [pa.nulls(len(once), f.type) for f in list(arrow)[1:-1]]
        yield pa.RecordBatch.from_arrays([ids.take(once), *empty, pa.array(counts).take(once)], schema=arrow)

    cells = _cells(standing, walking, shape, standing.count(), walking.count())
    found = _settled(cells.applyInArrow(best_of, schema), "candidates")
    counts = found.groupBy("query_id").agg(F.sum("met").alias("met"))
    enough = counts.filter(F.col("met") >= k).select("query_id")
    scored = found.filter("met IS NULL").join(enough, "query_id", "left_semi")
    best = top_per_key(scored, ["query_id"], k, F.desc("rank_score"), F.asc("lei"))
    best = best.select("query_id", "rank", *PAYLOAD, round_exact("score", 4).alias("score"))
    rest = asked.join(enough, "query_id", "left_anti")
    exact = search_batch(whole, rest, k)
    return best.unionByName(exact)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query, how many of the exact results there are and how many of them were found."""
    hits = found.select("query_id", "lei", F.lit(1).alias("hit"))
    return exact.select("query_id", "lei").join(hits, ["query_id", "lei"], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found")
    )
