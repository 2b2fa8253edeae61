"""Canonical table schemas and the ``conform`` projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "strings": T.ArrayType(T.StringType()),
    "vector": T.ArrayType(T.FloatType()),
}


def _fields(text: str, **nested: T.DataType) -> T.StructType:
    """``"a:string b:long"`` to a StructType; usable before a session exists."""
    pairs = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(n, nested.get(t) or _TYPES[t]) for n, t in pairs])


# One row per filing as landed from the registry.
REGISTRY = _fields(
    "lei:string legal_name:string other_names:string legal_address_line1:string "
    "legal_address_city:string country:string legal_address_postal:string "
    "hq_address_line1:string hq_address_city:string hq_country:string "
    "jurisdiction:string entity_status:string initial_registration_date:string "
    "last_update_date:string registration_status:string managing_lou:string",
)

ENTITIES = _fields(
    "lei:string legal_name:string normalized_name:string other_names:string "
    "legal_address_line1:string legal_address_city:string legal_address_postal:string "
    "country:string hq_address_line1:string hq_address_city:string hq_country:string "
    "jurisdiction:string entity_status:string initial_registration_date:timestamp_ntz "
    "last_update_date:timestamp_ntz registration_status:string managing_lou:string "
    "source:string",
)

STORED_ENTITIES = _fields(
    "id:string lei:string legal_name:string normalized_name:string country:string "
    "jurisdiction:string entity_status:string registration_status:string "
    "legal_address:legal_address headquarters_address:headquarters_address "
    "managing_lou:string source:string created_at:timestamp_ntz "
    "updated_at:timestamp_ntz",
    legal_address=_fields("line1:string city:string postal:string"),
    headquarters_address=_fields("line1:string city:string"),
)

MATCHES = _fields(
    "id:string lei_a:string lei_b:string name_a:string name_b:string "
    "name_similarity:double address_similarity:double embedding_similarity:double "
    "country_match:double jurisdiction_match:double final_score:double "
    "decision:string reason_codes:strings created_at:timestamp_ntz",
)

QUALITY_RUNS = _fields(
    "id:string run_date:timestamp_ntz total_records:long valid_records:long "
    "invalid_records:long missing_name_rate:double missing_address_rate:double "
    "duplicate_lei_count:long pipeline_runtime_seconds:double "
    "data_quality_score:double",
)

REPORTS = _fields(
    "id:string lei:string page:int report_text:string created_at:timestamp_ntz",
)

VECTORS = _fields(
    "lei:string embedding:vector",
)

WATCHLIST = _fields(
    "os_id:string os_name:string os_country:string os_schema:string "
    "os_datasets:string",
)

WATCHLIST_JSON = _fields(
    "id:string schema:string datasets:strings properties:properties "
    "_corrupt_record:string",
    properties=_fields("name:strings country:strings"),
)

RELATIONSHIPS = _fields(
    "lei:string parent_lei:string relationship_type:string",
)

REVIEWS = _fields(
    "match_id:string decision:string ts:timestamp_ntz seq:long",
)

NODES = _fields(
    "node_type:string id:string label:string",
)

EDGES = _fields(
    "src:string dst:string edge_type:string src_type:string dst_type:string "
    "final_score:double decision:string",
)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``; absent columns become typed nulls."""
    have = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        named = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in named]
    return df.select(*cols)
