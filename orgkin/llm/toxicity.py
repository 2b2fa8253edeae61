"""Toxicity by weak supervision.

Voters are lexicons and patterns. Some are fixed; the others are words and word beginnings
that stand out in toxic documents among the labelled ones, and beginnings that several words
of a text share. A label model estimates from the
votes on all documents how accurate and how correlated the voters are. A linear classifier
of hashed words is trained on the posterior labels and scores every document.

Labels are learned from where crc32 of the id is not divisible by 5; language, source and id
are no inputs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.llm import label_model as L
from orgkin.llm.common import documents, written

FOLDS = 5
MINED = 360  # words, and as many beginnings, that make up the mined lexicons
LEXICONS = 4
LEAST_SEEN = 3
BEGIN = 5
SHARED = (2, 3, 4)  # words with the same beginning that are a feature of their own
SPARSE = 0.8  # of the scorer's penalty: few of the many words tell toxicity
# --- Fixed values: insults of a general English list -----------------------------------
INSULTS = (
    "idiot idiots stupid moron morons loser losers scum trash clown pathetic worthless disgusting "
    "dumb fool foolish imbecile jerk creep pig filth garbage bastard shit fuck fucking bitch asshole "
    "crap damn hate kill ugly retard freak coward liar"
).split()
DISGUISED = r"(?i)\b(?:[i1!]d[i1!][o0]t|st[u*v]p[i1!*]d|m[o0*]r[o0*]n|l[o0*]s[e3*]r|tr[a@4*]sh|f[u*]ck|sh[i1!*]t|b[i1!*]tch)\b"
ADDRESSED = r"(?i)\byou(?:'re| are| r)? (?:an? |such an? |so |all )?(?:" + "|".join(INSULTS[:14]) + r")\b"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _words(text: Column) -> Column:
    """Distinct lower-case words; hyphens and apostrophes part them."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.array_distinct(split), "")


def _beginnings(words: Column) -> Column:
    """Beginnings of the words that are longer, one for each word."""
    long = F.filter(words, lambda w: F.length(w) > BEGIN)
    return F.transform(long, lambda w: F.concat(F.lit("^"), F.substr(w, F.lit(1), F.lit(BEGIN))))


def _shared(begins: Column, times: int) -> Column:
    """Beginnings, marked with ``times``, that as many words or more of the text share.

    ``begins`` is sorted, so such a beginning equals the one ``times - 1`` places on.
    """
    later = F.slice(begins, F.lit(times), F.size(begins))
    return F.array_compact(F.zip_with(
        begins, later, lambda x, y: F.when(x == y, F.concat(x, F.lit(f"*{times}")))
    ))


def _tokenized(rows: DataFrame) -> DataFrame:
    """``rows`` with ``tokens``: words, beginnings, and beginnings of several words.

    Each step is a column of its own, so that no text is split twice.
    """
    steps = rows.withColumn("_words", _words(F.col("text")))
    steps = steps.withColumn("_begins", F.array_sort(_beginnings(F.col("_words"))))
    parts = [F.col("_words"), F.col("_begins"), *[_shared(F.col("_begins"), k) for k in SHARED]]
    return steps.withColumn("tokens", F.array_distinct(F.concat(*parts))).drop("_words", "_begins")


def _mined(labelled: DataFrame) -> list[list[str]]:
    """The most telling tokens of the labelled rows, dealt over the lexicons by rank."""
    n = labelled.groupBy("toxic").count().collect()
    n = {r.toxic: r["count"] for r in n}
    if not n.get(1) or not n.get(0):
        return [[] for _ in range(LEXICONS)]
    seen = labelled.select(F.explode("tokens").alias("token"), "toxic").groupBy("token").agg(
        F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean")
    ).filter(F.col("in_toxic") >= LEAST_SEEN)
    lift = (F.col("in_toxic") / n[1]) / ((F.col("in_clean") + 1) / n[0])
    top = seen.withColumn("lift", lift).filter("lift > 4").orderBy(
        F.desc(F.col("lift") * F.sqrt("in_toxic")), "token"
    ).limit(MINED).collect()
    return [[r.token for r in top[k::LEXICONS]] for k in range(LEXICONS)]


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    A null or empty text is scored like one without words. A null id is not held out. Rows
    that share an id are scored each. Null labels and labels without a document are ignored;
    of several labels of an id the largest counts. Without labels of both classes every
    score is the one class's. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")))
    # A bounded sample of labelled rows, taken by hash before any text is read.
    total = known.count()
    share = min(1.0, L.TRAINED_ON / max(total, 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    labelled = _tokenized(rows.join(known, "doc_id").select("doc_id", "text", "toxic"))
    labelled = written(labelled, "toxic-labelled")
    lexicons = _mined(labelled)

    def vote(table: DataFrame, tokens: Column) -> DataFrame:
        has = lambda names: F.arrays_overlap(tokens, F.lit(names) if names else F.array(F.lit(" ")))
        text = F.coalesce(F.col("text"), F.lit(""))
        flags = {f"_v{k}": has(names) for k, names in enumerate(lexicons)}
        flags["_v_list"] = has(INSULTS)
        flags["_v_disguised"] = text.rlike(DISGUISED)
        flags["_v_addressed"] = text.rlike(ADDRESSED)
        every = [w for names in lexicons for w in names] or [" "]
        flags["_v_many"] = F.size(F.array_intersect(tokens, F.lit(every))) >= 3
        # A lexicon that is silent says little, so it abstains.
        return table.withColumns({k: F.when(v, 1).otherwise(0) for k, v in flags.items()})

    voters = [f"_v{k}" for k in range(LEXICONS)] + ["_v_list", "_v_disguised", "_v_addressed", "_v_many"]
    voted = vote(labelled, F.col("tokens"))
    # Everything that later steps need of a text, so that each text is read once.
    read = L.hashed(vote(_tokenized(rows), F.col("tokens")))
    read = written(read.select("doc_id", "held_out", *voters, "features"), "toxic-votes")
    patterns, counts, _ = L.pattern_counts(read, voters)
    mine, _, anchor = L.pattern_counts(voted, voters, F.col("toxic"))
    place = {tuple(p): i for i, p in enumerate(patterns.tolist())}
    known_counts = np.zeros((len(patterns), 2))
    for p, a in zip(mine.tolist(), anchor if anchor is not None else [], strict=True):
        known_counts[place[tuple(p)]] += a
    if len(patterns):
        guess = (known_counts[:, 1] + 0.1) / (known_counts.sum(1) + 1)
        model = L.fit(patterns, counts, guess, known_counts)
        posterior = L.posterior_column(voters, patterns, model.posterior(patterns))
    else:
        posterior = F.lit(0.0)
    train = L.hashed(voted).select("features", posterior.alias("posterior"))
    result = L.scored_features(read.select("doc_id", "held_out", "features"), train, SPARSE)
    return result.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def query(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
