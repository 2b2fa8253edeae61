"""Quality by weak labels: overlapping heuristic labellers, expectation-maximisation for
their accuracies from the votes on all documents, and a hashed linear scorer trained on the
posterior labels. No human label is used."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.llm import label_model as L
from orgkin.llm.common import SPACES, documents, words, written

# --- Fixed values: frequent words of English, German, French and Spanish -----------------
STOP_WORDS = (
    "the of and to in is that for with as was by on are this be from or an at it a "
    "der die das und ist nicht mit von den zu ein eine für auf dem des im sich auch "
    "le la les de des un une et est que qui dans pour par sur pas au avec en du "
    "el los las del que y se por con para una su no es lo como"
).split()


def _statistics(text: Column, w: Column, kinds: Column) -> dict[str, Column]:
    """``w``: the words of the text, ``kinds``: the distinct ones."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    ended = F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?…\"')]$"))
    chars = F.length(F.translate(text, SPACES, ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    n, c = F.greatest(F.size(w), F.lit(1)), F.greatest(chars, F.lit(1))
    return {
        "_words": F.size(w).cast("double"),
        "_letters": letters / c,
        "_kinds": F.size(kinds) / n,
        "_repeated": 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "_length": c / n,
        "_stops": F.size(F.array_intersect(kinds, F.lit(STOP_WORDS))).cast("double"),
        "_ended": F.size(ended) / F.greatest(F.size(lines), F.lit(1)),
        "_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>{}[]\\~^", ""))) / n,
        "_line": n / F.greatest(F.size(lines), F.lit(1)),
    }


#: name -> (votes bad, votes good) as SQL conditions on the statistics; else it abstains.
LABELLERS = {
    "_v_words": ("_words < 4", "_words >= 50"),
    "_v_letters": ("_letters < 0.75", "_letters > 0.9"),
    "_v_kinds": ("_kinds < 0.1 * least(1.0, 400 / greatest(_words, 1))", "_kinds > 0.3 and _words > 20"),
    "_v_repeated": ("_repeated > 0.3", "_repeated < 0.1 and _line < 400"),
    "_v_length": ("_length < 2.5 or _length > 12", "_length between 3.5 and 8"),
    "_v_stops": ("_stops < 2", "_stops >= 5"),
    "_v_ended": ("_ended < 0.3", "_ended > 0.8"),
    "_v_symbols": ("_symbols > 0.3", "_symbols < 0.05"),
    "_v_line": ("_line < 3", "_line > 6"),
}


def quality(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, score`` (0 to 1, higher is better) and ``kept``.

    A null or empty text is scored like one without words. Ids may be null or repeat; other
    columns are ignored; an empty table gives no rows. If all votes fall into one class,
    every score is that class's.
    """
    rows = (
        docs.select("doc_id", F.col("text").alias("text"))
        .withColumn("_w", words(F.lower("text"))).withColumn("_k", F.array_distinct("_w"))
    )
    rows = rows.withColumns(_statistics(F.col("text"), F.col("_w"), F.col("_k")))
    votes = {
        name: F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
        for name, (bad, good) in LABELLERS.items()
    }
    # Tokens: word kinds and the statistics in coarse steps.
    step = lambda c, k: F.floor(F.col(c) * k).cast("string")
    shapes = F.array(
        F.concat(F.lit("#words"), F.floor(F.log2(F.col("_words") + 1)).cast("string")),
        *[F.concat(F.lit("#" + c), step(c, k)) for c, k in (
            ("_letters", 20), ("_kinds", 10), ("_repeated", 10), ("_ended", 10), ("_symbols", 10),
        )],
        F.concat(F.lit("#length"), step("_length", 1)),
        F.concat(F.lit("#stops"), F.least("_stops", F.lit(9.0)).cast("string")),
        F.concat(F.lit("#line"), F.floor(F.log2(F.col("_line") + 1)).cast("string")),
    )
    # Everything that later steps need of a text, so that each text is read once.
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)).alias("_at")
    read = L.hashed(rows.withColumns(votes).withColumn("tokens", F.concat(shapes, "_k")))
    voted = written(read.select("doc_id", *LABELLERS, at, "features"), "quality-votes")
    voters = list(LABELLERS)
    patterns, counts, _ = L.pattern_counts(voted, voters)
    if len(patterns):
        start = 1 / (1 + np.exp(-(patterns.sum(1) - 1.0)))
        model = L.fit(patterns, counts, start)
        posterior = L.posterior_column(voters, patterns, model.posterior(patterns))
    else:
        posterior = F.lit(0.0)
    share = min(1.0, L.TRAINED_ON / max(int(counts.sum()), 1))
    train = voted.filter(F.col("_at") < int(share * (1 << 20)))
    result = L.scored_features(
        voted.select("doc_id", "features"), train.select("features", posterior.alias("posterior"))
    )
    return result.select("doc_id", "score", (F.col("score") >= 0.5).alias("kept"))


def query(spark, sf_dir):
    return quality(documents(spark, sf_dir))
