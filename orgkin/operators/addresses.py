"""Address nodes of the graph, and companies that share an address.

An address of formation agents may hold a large share of all companies. Up to ``hub``
companies of an address form pairs; the others stay one row per member, which says the
same without a row for every pair, so no link is lost and no task makes them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.functions.text import ascii_fold
from orgkin.operators.graph import COMPANY
from orgkin.operators.keyed import keyed_join

ADDRESS = "Address"
#: edge type -> line, city, country. Postal codes are left out: headquarters have none.
PARTS = {
    "LEGAL_ADDRESS": ("legal_address_line1", "legal_address_city", "country"),
    "HEADQUARTERS_ADDRESS": ("hq_address_line1", "hq_address_city", "hq_country"),
}
HUB = 200  # companies of an address that form pairs; an address of more is a hub


def address_text(line: str, city: str, country: str) -> Column:
    """Upper-case ASCII words of an address; null without a line or without any word."""
    said = F.concat_ws(" ", line, city, country)
    plain = F.trim(F.regexp_replace(F.upper(ascii_fold(said)), "[^A-Z0-9]+", " "))
    named = F.col(line).isNotNull() & (F.trim(F.col(line)) != "")
    return F.when(named, F.nullif(plain, F.lit("")))


def entity_addresses(entities: DataFrame) -> DataFrame:
    """Distinct ``lei, edge_type, address_id, label``; rows without a key have none.

    Cleaned entities are expected; columns of an address that are absent read as null.
    """
    have = set(entities.columns)
    wanted = {c for parts in PARTS.values() for c in parts}
    rows = entities.withColumns({c: F.lit(None).cast("string") for c in sorted(wanted - have)})
    each = F.array(*[
        F.struct(F.lit(kind).alias("edge_type"), address_text(*parts).alias("label"))
        for kind, parts in PARTS.items()
    ])
    said = rows.filter(F.col("lei").isNotNull()).select("lei", F.explode(each).alias("_a"))
    known = said.select("lei", "_a.*").filter(F.col("label").isNotNull()).distinct()
    return known.select("lei", "edge_type", F.sha2("label", 256).alias("address_id"), "label")


def address_nodes(entities: DataFrame) -> DataFrame:
    nodes = entity_addresses(entities).select("address_id", "label").distinct()
    return nodes.select(F.lit(ADDRESS).alias("node_type"), F.col("address_id").alias("id"), "label")


def address_edges(entities: DataFrame) -> DataFrame:
    """Edges in the layout of the other graph edges."""
    return entity_addresses(entities).select(
        F.col("lei").alias("src"), F.col("address_id").alias("dst"), "edge_type",
        F.lit(COMPANY).alias("src_type"), F.lit(ADDRESS).alias("dst_type"),
        F.lit(None).cast("double").alias("final_score"), F.lit(None).cast("string").alias("decision"),
    )


def address_members(entities: DataFrame) -> DataFrame:
    """``address_id, lei, companies``: who is at an address, and how many are.

    Counts are aggregated before the shuffle, and the join back splits a hot address.
    """
    members = entity_addresses(entities).select("address_id", "lei").distinct()
    sizes = members.groupBy("address_id").agg(F.count(F.lit(1)).alias("companies"))
    return keyed_join(members, sizes, "address_id")


def co_located(members: DataFrame, hub: int = HUB) -> DataFrame:
    """Pairs ``lei_a < lei_b`` that share addresses which are no hubs, with their number."""
    small = members.filter(F.col("companies").between(2, hub))
    a = small.select("address_id", F.col("lei").alias("lei_a"))
    b = small.select("address_id", F.col("lei").alias("lei_b"))
    pairs = a.join(b, "address_id").filter("lei_a < lei_b")
    return pairs.groupBy("lei_a", "lei_b").agg(F.count(F.lit(1)).alias("addresses"))


def hub_members(members: DataFrame, hub: int = HUB) -> DataFrame:
    """The members of hubs: any two rows of an address are linked."""
    return members.filter(F.col("companies") > hub)


def sharing(members: DataFrame, hub: int = HUB) -> DataFrame:
    """Per company: its addresses, those of them that are hubs, and places taken by others.

    No pairs are formed; a company met at two addresses counts twice.
    """
    return members.groupBy("lei").agg(
        F.count(F.lit(1)).alias("addresses"), F.count_if(F.col("companies") > hub).alias("hubs"),
        F.sum(F.col("companies") - 1).alias("others"),
    )
