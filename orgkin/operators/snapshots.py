"""Stored tables that change or are paged through without being read whole.

A bucketed snapshot deals its rows over buckets by a hash of their key. A version is a
manifest, one row per bucket with the folder that holds it; the next version names new
folders for the buckets a load touches and the old ones for all others. Writing the
manifest is what commits a version: folders of a run that died are named by none.

An ordered table is laid out in ranges of its sort keys with an index of its files, one row
each. A page follows a cursor, the sort keys of the last row seen, so it opens the files
from the cursor on that it needs, whatever its number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orgkin.operators.ownership import settled
from orgkin.sources.tables import read_or_none

BUCKETS = 64
FILES = 64
_MANIFEST = "version long, bucket int, folder string, rows long"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


@dataclass
class Snapshot:
    """A version of a bucketed table: its manifest, and how it is laid out."""

    spark: SparkSession
    path: str
    version: int
    buckets: int
    schema: StructType
    folders: dict[int, str]
    rows: dict[int, int]

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of the given buckets, of all by default."""
        names = [f for b, f in sorted(self.folders.items()) if buckets is None or b in buckets]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*names)


def _written(df: DataFrame, path: str, key: str, buckets: int) -> tuple[dict, dict]:
    """Rows in a folder per bucket; the folders and their row counts."""
    data = f"{path}/data-{uuid.uuid4().hex}"
    dealt = df.withColumn("bucket", _bucket(key, buckets)).repartition("bucket")
    dealt.write.partitionBy("bucket").parquet(data)
    found = df.sparkSession.read.schema(dealt.schema).parquet(data)
    counts = {r["bucket"]: r["n"] for r in found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {b: f"{data}/bucket={b}" for b in counts}, counts


def _committed(spark: SparkSession, path: str, version: int, buckets: int, schema, folders: dict, rows: dict) -> Snapshot:
    manifest = [(version, b, f, rows[b]) for b, f in sorted(folders.items())] or [(version, -1, "", 0)]
    # one small file: a row per bucket, and the layout in a comment row
    layout = json.dumps({"buckets": buckets, "schema": schema.json()})
    spark.createDataFrame([*manifest, (version, -2, layout, 0)], _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/version={version}")
    return Snapshot(spark, path, version, buckets, schema, folders, rows)


def create_snapshot(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> Snapshot:
    """The first version of a table whose ``key`` is unique."""
    folders, rows = _written(df, path, key, buckets)
    return _committed(df.sparkSession, path, 0, buckets, df.schema, folders, rows)


def open_snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest committed version, or an older one; None if there is none."""
    found = read_or_none(spark, f"{path}/manifest")
    if found is None:
        return None
    newest = found.agg(F.max("version")).first()[0] if version is None else version
    rows = found.filter(F.col("version") == newest).collect()
    layout = json.loads(next(r["folder"] for r in rows if r["bucket"] == -2))
    own = [r for r in rows if r["bucket"] >= 0]
    return Snapshot(
        spark, path, newest, layout["buckets"], StructType.fromJson(json.loads(layout["schema"])),
        {r["bucket"]: r["folder"] for r in own}, {r["bucket"]: r["rows"] for r in own},
    )


def upsert_snapshot(
    snapshot: Snapshot, load: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> Snapshot:
    """The next version: ``merge(stored rows, load)`` of the buckets that the load has keys of.

    The other buckets are neither read nor written. A load whose keys are all null changes nothing
    but the version. Repeating a load makes a version with the same rows; a run that fails
    leaves the newest version as it was, and a lost executor repeats its own tasks.
    """
    keyed = settled(load.filter(F.col(key).isNotNull()), "load")
    touched = [r["b"] for r in keyed.select(_bucket(key, snapshot.buckets).alias("b")).distinct().collect()]
    folders, rows = dict(snapshot.folders), dict(snapshot.rows)
    if touched:
        merged = merge(snapshot.read(touched), keyed)
        new, counts = _written(merged.select(*snapshot.schema.fieldNames()), snapshot.path, key, snapshot.buckets)
        for b in touched:
            folders.pop(b, None)
            rows.pop(b, None)
        folders.update(new)
        rows.update(counts)
    return _committed(snapshot.spark, snapshot.path, snapshot.version + 1, snapshot.buckets, snapshot.schema, folders, rows)


@dataclass
class OrderedTable:
    """Rows in ranges of ``_o0, _o1, ...``; ``files`` has the first and last keys of each."""

    spark: SparkSession
    path: str
    keys: int
    schema: StructType

    def _after(self, cursor: Sequence, columns: Sequence[str]) -> Column:
        """Keys after the cursor in their order."""
        out = F.lit(False)
        for c, v in reversed(list(zip(columns, cursor, strict=True))):
            out = (F.col(c) > F.lit(v)) | ((F.col(c) == F.lit(v)) & out)
        # of the first key alone, so that it reaches the scan
        return (F.col(columns[0]) >= F.lit(cursor[0])) & out

    def page(self, limit: int, cursor: Sequence | None = None, where: Column | None = None) -> tuple[DataFrame, list | None]:
        """The next ``limit`` rows after the cursor, and the cursor behind them (None at the end).

        Files are opened in order, twice as many each time, until the page is full.
        """
        own = [f"_o{i}" for i in range(self.keys)]
        files = self.spark.read.parquet(f"{self.path}/files")
        if cursor is not None:
            files = files.filter(self._after(cursor, [f"_last{i}" for i in range(self.keys)]))
        schema = self.schema
        first = [F.col(f"_first{i}") for i in range(self.keys)]
        opened, at = [], 1
        found = self.spark.createDataFrame([], schema)
        while True:
            names = [r["file"] for r in files.orderBy(*first, "file").limit(at).collect()]
            if names == opened:
                break
            opened = names
            rows = self.spark.read.schema(schema).parquet(*names)
            if cursor is not None:
                rows = rows.filter(self._after(cursor, own))
            if where is not None:
                rows = rows.filter(where)
            found = rows.orderBy(*own).limit(limit)
            if len(names) < at or found.count() == limit:
                break
            at *= 2
        last = found.orderBy(*[F.desc(c) for c in own]).limit(1).select(*own).collect()
        shown = found.orderBy(*own).drop(*own)
        return shown, list(last[0]) if last else None


def write_ordered(df: DataFrame, path: str, order: Sequence[Column], files: int = FILES) -> OrderedTable:
    """Lay a table out in the order of the given expressions, all ascending and without nulls
    (a descending number is its negative). The last ones should tell all rows apart."""
    keys = {f"_o{i}": c for i, c in enumerate(order)}
    rows = df.withColumns(keys)
    rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.parquet(f"{path}/rows")
    back = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
    place = F.struct(*keys)
    index = back.groupBy(F.input_file_name().alias("file")).agg(
        F.min(place).alias("f"), F.max(place).alias("l"), F.count(F.lit(1)).alias("rows")
    )
    index.select(
        "file", "rows", *[F.col(f"f.{k}").alias(f"_first{i}") for i, k in enumerate(keys)],
        *[F.col(f"l.{k}").alias(f"_last{i}") for i, k in enumerate(keys)],
    ).coalesce(1).write.parquet(f"{path}/files")
    return OrderedTable(df.sparkSession, path, len(keys), rows.schema)
