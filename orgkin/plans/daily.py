"""The daily batch: clean, check, vectorise, resolve and load, from one driver.

Every stage is a lazy frame. What several stages share (clean entities, vectors,
matches) is written once as a table and read back, so a lost executor costs one
stage at most.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from orgkin import refdata as R
from orgkin.operators import graph, merge, quality, resolve, vectors
from orgkin.operators.clean import clean_entities
from orgkin.sources import tables


@dataclass
class Run:
    """Where a run left its tables, and the row counts seen on the way."""

    folder: str
    rows: dict[str, int] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"


def run_daily(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    as_of: dt.datetime,
    run_id: str,
    duplicates: int | None = None,
    relationships: DataFrame | None = None,
    previous: Run | None = None,
    dimensions: int = vectors.DIMENSIONS,
    copies_in_graph: bool = False,
) -> Run:
    """One batch over raw registry rows (with ``ingest_ord``) into a new folder.

    Snapshots of an earlier run are merged into when ``previous`` is given. With
    ``copies_in_graph`` the marked copies are nodes too, so matches with them become edges.
    """
    run = Run(folder)

    def stage(name: str, df: DataFrame, blanks: bool = False) -> DataFrame:
        watched, seen = tables.counted(df, name)
        back = tables.write_stage(watched, run.path(name), blanks=blanks)
        run.rows[name] = seen.get["rows"]
        return back

    def stored(name: str, empty: DataFrame) -> DataFrame:
        found = tables.read_or_none(spark, previous.path(name)) if previous else None
        return empty if found is None else found

    clean = stage("clean_entities", clean_entities(raw))
    dup = stage("clean_duplicates", clean_entities(resolve.labelled_duplicates(raw, duplicates)))

    started = time.time()
    metrics = quality.timed(quality.quality_metrics(clean, as_of), started)
    tables.write_quality_report(metrics, run.path("quality_reports"), run_id)
    tables.quality_run_row(metrics).write.mode("append").parquet(run.path("quality_runs"))

    model = vectors.fit_embedder(clean, dimensions)
    embedded = stage("vectors", vectors.embed(clean, model))
    found = stage("matches", resolve.resolve(clean, dup, embedded, as_of))

    snapshot = merge.entity_rows(clean, as_of)
    stage("entities", merge.upsert_entities(
        stored("entities", snapshot.limit(0)), clean, as_of), blanks=True)
    old = stored("match_table", found.limit(0))
    stage("match_table", old.unionByName(merge.new_rows(old, found)))

    points = vectors.index_rows(clean, embedded)
    stage("vector_index", vectors.upsert_index(
        stored("vector_index", points.limit(0)), clean, embedded), blanks=True)

    companies = graph.entity_nodes(clean)
    if copies_in_graph:
        companies = companies.unionByName(graph.company_nodes(dup))
    nodes = stage("nodes", companies)
    edges = graph.entity_edges(clean).unionByName(graph.match_edges(found, nodes))
    if relationships is not None:
        edges = edges.unionByName(graph.ownership_edges(relationships, nodes))
    stage("edges", edges)
    return run
