"""Property-graph tables and one-hop queries on them.

Nodes are (node_type, id, label), edges (src, dst, edge_type, ...). Country and
jurisdiction nodes are labelled by their own code, so an edge never has to be joined
with a country node that a third of all companies point to. Query results stay one
row per node or edge: nothing is collected into per-company lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin import refdata as R
from orgkin.operators.keyed import first_per_key, keyed_join

COMPANY, COUNTRY, JURISDICTION = "Company", "Country", "Jurisdiction"
LOCATED_IN, REGISTERED_IN, MATCHED_TO = "LOCATED_IN", "REGISTERED_IN", "MATCHED_TO"
PARENT_EDGES = {"DIRECT": "HAS_DIRECT_PARENT", "ULTIMATE": "HAS_ULTIMATE_PARENT"}


def company_nodes(entities: DataFrame, order: str | None = None) -> DataFrame:
    """One company node per lei; the last row in ``order`` sets its properties."""
    rows = entities.filter(F.col("lei").isNotNull())
    if order is not None:
        rows = first_per_key(rows, ["lei"], F.desc_nulls_last(order))
    return rows.select(
        F.lit(COMPANY).alias("node_type"), F.col("lei").alias("id"),
        F.col("legal_name").alias("label"),
    )


def code_nodes(entities: DataFrame) -> DataFrame:
    """Distinct country and jurisdiction nodes of rows with a key."""
    pairs = entities.filter(F.col("lei").isNotNull()).select(
        F.explode(
            F.array(
                F.struct(F.lit(COUNTRY).alias("node_type"), F.col("country").alias("id")),
                F.struct(F.lit(JURISDICTION).alias("node_type"), F.col("jurisdiction").alias("id")),
            )
        ).alias("n")
    )
    codes = pairs.select("n.*").filter(F.col("id").isNotNull()).dropDuplicates(["node_type", "id"])
    return codes.select("node_type", "id", F.col("id").alias("label"))


def entity_nodes(entities: DataFrame, order: str | None = None) -> DataFrame:
    return company_nodes(entities, order).unionByName(code_nodes(entities))


def _edges(df: DataFrame, src, dst, edge_type, dst_type, score=None, decision=None) -> DataFrame:
    return df.select(
        src.alias("src"), dst.alias("dst"), edge_type.alias("edge_type"),
        F.lit(COMPANY).alias("src_type"), dst_type.alias("dst_type"),
        (F.lit(None) if score is None else score).cast("double").alias("final_score"),
        (F.lit(None) if decision is None else decision).cast("string").alias("decision"),
    )


def entity_edges(entities: DataFrame) -> DataFrame:
    """Located-in and registered-in edges of rows that carry the code, once each."""
    links = entities.filter(F.col("lei").isNotNull()).select(
        "lei",
        F.explode(
            F.array(
                F.struct(F.lit(LOCATED_IN).alias("t"), F.lit(COUNTRY).alias("k"),
                         F.col("country").alias("code")),
                F.struct(F.lit(REGISTERED_IN).alias("t"), F.lit(JURISDICTION).alias("k"),
                         F.col("jurisdiction").alias("code")),
            )
        ).alias("l"),
    )
    present = links.filter(F.col("l.code").isNotNull()).dropDuplicates()
    return _edges(
        present, F.col("lei"), F.col("l.code"), F.col("l.t"), F.col("l.k")
    )


def _known(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named columns are all company keys."""
    companies = nodes.filter(F.col("node_type") == COMPANY)
    for c in columns:
        rows = keyed_join(rows, companies.select(F.col("id").alias(c)), c, "left_semi")
    return rows


def match_edges(matches: DataFrame, nodes: DataFrame, order: str = "created_at") -> DataFrame:
    """Edges of merge and review decisions between known companies, last one per pair.

    Of rows with equal ``order`` the best scored stays, then the larger decision.
    """
    linked = matches.filter(F.col("decision").isin(*R.LINKED_DECISIONS))
    known = _known(linked, nodes, "lei_a", "lei_b")
    newest = [F.desc(order)] if order in matches.columns else []
    last = first_per_key(
        known, ["lei_a", "lei_b"], *newest, F.desc("final_score"), F.desc("decision")
    )
    return _edges(
        last, F.col("lei_a"), F.col("lei_b"), F.lit(MATCHED_TO), F.lit(COMPANY),
        F.col("final_score"), F.col("decision"),
    )


def ownership_edges(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """Parent edges of the two known relationship types between known companies."""
    kind = F.lit(None).cast("string")
    for name, edge in PARENT_EDGES.items():
        kind = F.when(F.col("relationship_type") == name, F.lit(edge)).otherwise(kind)
    typed = relationships.withColumn("_edge", kind).filter(F.col("_edge").isNotNull())
    once = _known(typed.dropDuplicates(["lei", "parent_lei", "_edge"]), nodes, "lei", "parent_lei")
    return _edges(once, F.col("lei"), F.col("parent_lei"), F.col("_edge"), F.lit(COMPANY))


def incident_edges(edges: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Distinct (key, direction, edge_type, other, other_type) of the asked companies.

    ``keys`` has one ``key`` column; every company is asked when it is None.
    """
    out = edges.select(
        F.col("src").alias("key"), F.lit("out").alias("direction"), "edge_type",
        F.col("dst").alias("other"), F.col("dst_type").alias("other_type"),
    )
    into = edges.filter(F.col("dst_type") == COMPANY).select(
        F.col("dst").alias("key"), F.lit("in").alias("direction"), "edge_type",
        F.col("src").alias("other"), F.col("src_type").alias("other_type"),
    )
    both = out.unionByName(into)
    if keys is not None:
        both = keyed_join(both, keys.select("key").distinct(), "key", "left_semi")
    return both.dropDuplicates()


def _labelled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Attach ``label`` to ``other``: a company's name, else the code itself."""
    names = nodes.filter(F.col("node_type") == COMPANY).select(
        F.col("id").alias("other"), F.col("label").alias("_name")
    )
    company = F.col("other_type") == COMPANY
    # codes carry their own label, so only company endpoints take part in the join
    named = keyed_join(rows.filter(company), names, "other", "left")
    codes = rows.filter(~company).withColumn("_name", F.lit(None).cast("string"))
    return named.unionByName(codes).withColumn("label", F.coalesce("_name", "other")).drop("_name")


def neighbourhood_edges(edges: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One-hop edges per asked company, in both directions."""
    out = F.col("direction") == "out"
    return incident_edges(edges, keys).select(
        "key",
        F.when(out, F.col("key")).otherwise(F.col("other")).alias("source"),
        F.when(out, F.col("other")).otherwise(F.col("key")).alias("target"),
        "edge_type",
    )


def neighbourhood_nodes(
    nodes: DataFrame, edges: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Centre and one-hop nodes per asked company, once per id; unknown keys give none.

    When one id arrives several ways the last of centre, outgoing, incoming wins.
    """
    centres = nodes.filter(F.col("node_type") == COMPANY).select(
        F.col("id").alias("key"), F.col("id").alias("other"),
        F.lit(COMPANY).alias("other_type"), F.coalesce("label", "id").alias("label"),
        F.lit(0).alias("_step"), F.lit("").alias("edge_type"),
    )
    if keys is not None:
        centres = centres.join(keys.select("key").distinct(), "key", "left_semi")
    around = _labelled(incident_edges(edges, keys), nodes).select(
        "key", "other", "other_type", "label",
        F.when(F.col("direction") == "out", 1).otherwise(2).alias("_step"), "edge_type",
    )
    rows = centres.unionByName(around).filter(F.coalesce("other", F.lit("")) != "")
    last = first_per_key(
        rows, ["key", "other"], F.desc("_step"), F.desc("edge_type"), F.desc("other_type")
    )
    return last.select(
        "key", F.col("other").alias("id"), "label", F.col("other_type").alias("type")
    )


def relationship_list(
    nodes: DataFrame, edges: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Outgoing relationships: type, target label, company key or '', target type."""
    out = edges.select(
        F.col("src").alias("key"), "edge_type",
        F.col("dst").alias("other"), F.col("dst_type").alias("other_type"),
    )
    if keys is not None:
        out = keyed_join(out, keys.select("key").distinct(), "key", "left_semi")
    return _labelled(out, nodes).select(
        "key", F.col("edge_type").alias("rel_type"), F.col("label").alias("target_label"),
        F.when(F.col("other_type") == COMPANY, F.col("other")).otherwise("").alias("target_lei"),
        F.col("other_type").alias("target_type"),
    )
