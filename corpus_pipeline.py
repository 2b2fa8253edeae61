"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orgkin.llm.byte_bpe import digests
from orgkin.llm.common import written
from orgkin.llm.jaccard_join import one_of_each
from orgkin.llm.mixing import mixed_documents
from orgkin.llm.pii import replace_pii
from orgkin.llm.quality_rules import keep_documents
from orgkin.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    ship_package(spark)
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with surrogates for personal data."""
    return replace_pii(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    ship_package(spark)
    return digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: Robust estimates, near duplicates and tokens are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage-" + name.replace(" ", "-"))
    return docs
