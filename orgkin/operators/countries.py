"""Country texts that no table holds, ranked by the character triples they share with names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.functions.country import country_key, country_names, known_country, normalize_country
from orgkin.operators.keyed import top_per_key

LEAST = 0.4  # similarity from which a ranked country is taken
MOST_NAMES = 10_000  # names travel to every task


def triples(key: Column) -> Column:
    """Distinct runs of three characters of a key with two blanks before and one behind."""
    padded = F.concat(F.lit("  "), key, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(key) + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(3))))


def _names(names: DataFrame | None, texts: DataFrame) -> DataFrame:
    if names is None:
        return texts.sparkSession.createDataFrame(country_names(), "code string, name string")
    if names.limit(MOST_NAMES + 1).count() > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} country names")
    return names.select("code", "name").filter(F.col("code").isNotNull())


def ranked_countries(texts: DataFrame, column: str, k: int = 3, names: DataFrame | None = None) -> DataFrame:
    """``text, rank, code, score`` of the ``k`` likeliest countries of every distinct text.

    The score is twice the triples in common by the triples of both, best name of each code;
    ties go to the smaller code. ``names`` (code, name) replaces the ISO names and aliases.
    Texts without a letter, nulls included, have no row; neither have texts that share nothing.
    """
    table = _names(names, texts).withColumn("_t", triples(country_key(F.col("name"))))
    known = table.select("code", "name", F.size("_t").alias("_b"), F.explode("_t").alias("_triple"))
    asked = texts.select(F.col(column).alias("text")).distinct().withColumn("_key", country_key(F.col("text")))
    asked = asked.filter(F.col("_key") != "").withColumn("_t", triples(F.col("_key")))
    asked = asked.select("text", F.size("_t").alias("_a"), F.explode("_t").alias("_triple"))
    shared = asked.join(F.broadcast(known), "_triple").groupBy("text", "code", "name", "_a", "_b").agg(
        F.count(F.lit(1)).alias("_n")
    )
    score = 2 * F.col("_n") / (F.col("_a") + F.col("_b"))
    best = shared.groupBy("text", "code").agg(F.max(score).alias("score"))
    return top_per_key(best, ["text"], k, F.desc("score"), F.asc("code")).select("text", "rank", "code", "score")


def resolve_countries(
    df: DataFrame, column: str, out: str, least: float = LEAST, names: DataFrame | None = None
) -> DataFrame:
    """``df`` with the code of ``column`` as ``out``: by the tables first, then the likeliest name.

    Below ``least`` the first two characters stay, as ``normalize_country`` leaves them. Only
    texts that the tables do not know are ranked, each once.
    """
    unknown = F.when(known_country(column).isNull(), F.col(column))
    open_texts = df.select(unknown.alias("_text")).filter(F.col("_text").isNotNull())
    best = ranked_countries(open_texts, "_text", 1, names).filter(F.col("score") >= least)
    best = best.select(F.col("text").alias("_text"), F.col("code").alias("_code"))
    done = df.withColumn("_text", unknown).join(best, "_text", "left")
    return done.withColumn(out, F.coalesce("_code", normalize_country(column))).drop("_text", "_code")
