"""Plain CSV files with quoted line breaks, read by many tasks.

Spark splits a text file into byte ranges at line ends. Whether a line begins inside quotes
depends on all quotes before it, so one pass counts the quotes of each range, a running sum over
ranges says how each one begins, and the second pass knows for each line if it opens a record.
Lines that are a record by themselves, nearly all, are parsed where they are read; only the
lines of broken records are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

_LINE = "file string, start bigint, line bigint, before bigint, quotes bigint, value string"
_RANGE = ["file", "start"]


def _plain(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file and the byte its range starts at."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _lines(plain: DataFrame) -> DataFrame:
    """Lines with their number and the quotes before them within their range."""

    def numbered(batches):
        at, line, before = None, 0, 0
        for rows in batches:
            if not rows.num_rows:
                continue
            quotes = pc.count_substring(rows.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
            file = rows.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            start = rows.column("start").to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.concatenate(([True], (file[1:] != file[:-1]) | (start[1:] != start[:-1]))))
            size = np.diff(np.append(begins, len(start)))
            lines = np.arange(len(start)) - np.repeat(begins, size)
            earlier = np.cumsum(quotes) - quotes
            earlier -= np.repeat(earlier[begins], size)
            if at == (rows.column("file")[0].as_py(), int(start[0])):  # the last batch ended in this range
                lines[: size[0]] += line
                earlier[: size[0]] += before
            at, line, before = (rows.column("file")[-1].as_py(), int(start[-1])), int(lines[-1]) + 1, int(earlier[-1] + quotes[-1])
            yield pa.RecordBatch.from_arrays(
                [rows.column("file"), rows.column("start"), pa.array(lines), pa.array(earlier), pa.array(quotes), rows.column("value")],
                names=["file", "start", "line", "before", "quotes", "value"],
            )

    return plain.mapInArrow(numbered, _LINE)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, line, record`` of every record of the files at ``path``, headers included.

    ``start`` and ``line`` are those of its first line. A quote inside a field is doubled, so
    a line begins inside quotes if an odd number of quotes stands before it. Blank lines between
    records are left out; an unclosed quote runs to the end of its file.
    """
    plain = _plain(spark, path)
    lines = _lines(plain)
    ordered = W.partitionBy("file").orderBy("start")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = plain.groupBy(*_RANGE).agg(F.sum(quotes).alias("quotes"))
    earlier = F.sum("quotes").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    ranges = ranges.select(*_RANGE, F.coalesce(earlier, F.lit(0)).alias("carried"))
    # ranges are few (one for each 128 MB or so), so the lines stay where they are read
    marked = lines.join(F.broadcast(ranges), _RANGE).withColumn("opens", (F.col("carried") + F.col("before")) % 2 == 0)
    whole = F.col("opens") & (F.col("quotes") % 2 == 0)
    single = marked.filter(whole).select(*_RANGE, "line", F.col("value").alias("record"))

    # a line inside a record belongs to the nearest opening line before it: in its own range, or the last
    # one of an earlier range
    parts = marked.filter(~whole)
    opener = F.max(F.when(F.col("opens"), F.col("line")))
    own = opener.over(W.partitionBy(*_RANGE).orderBy("line"))
    last = parts.groupBy(*_RANGE).agg(opener.alias("_line"))
    here = F.when(F.col("_line").isNotNull(), F.struct("start", "_line"))
    inherited = F.last(here, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    last = last.select(*_RANGE, inherited.alias("_before"))
    placed = parts.withColumn("_own", own).join(F.broadcast(last), _RANGE).withColumns({
        "_start": F.when(F.col("_own").isNotNull(), F.col("start")).otherwise(F.col("_before.start")),
        "_first": F.coalesce("_own", F.col("_before._line")),
    })
    joined = placed.groupBy("file", "_start", "_first").agg(
        F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("rows")
    )
    broken = joined.select(
        "file", F.col("_start").alias("start"), F.col("_first").alias("line"),
        F.array_join(F.transform("rows", lambda r: r["value"]), "\n").alias("record"),
    )
    tidy = F.regexp_replace("record", "\r$", "")
    return single.unionByName(broken).withColumn("record", tidy).filter(F.trim("record") != "")


def scan_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of plain files with one header, as strings.

    Same rows as the whole-file read, but a file takes as many tasks as it has ranges. Compressed
    files can't be split: each is one range. Files with another header raise an error when read.
    """
    names = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=False).columns
    ddl = ", ".join(f"`{n}` string" for n in names)
    records = csv_records(spark, path)
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    parsed = records.select("start", "line", F.from_csv("record", ddl, options).alias("r"))
    header = (F.col("start") == 0) & (F.col("line") == 0)
    first = F.transform(F.array(*[F.col(f"r.`{n}`") for n in names]), lambda x: F.regexp_replace(x, "^﻿", ""))
    wanted = F.array(*[F.lit(n.removeprefix("﻿")) for n in names])
    checked = F.when(first != wanted, F.raise_error(F.lit("a file has another header"))).otherwise(F.lit(False))
    return parsed.filter(F.when(header, checked.cast("boolean")).otherwise(F.lit(True))).select(
        *[F.col(f"r.`{n}`").alias(n) for n in names]
    )
