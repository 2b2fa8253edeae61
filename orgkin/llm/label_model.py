"""A generative model of weak voters, and a linear scorer trained on its labels.

Votes are 1, -1 or 0 (abstains). The corpus comes in as counts of vote patterns: with m
voters at most 3**m rows, so at most MOST_VOTERS of them keep the table small whatever the
corpus is. Expectation-maximisation estimates how each voter votes for each class; voters
that agree beyond what the class explains are correlated, and each then counts for less.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import written

MOST_VOTERS = 10
VALUES = (-1, 0, 1)
STEPS = 40
SMOOTHING = 1.0
CORRELATED = 0.2
DIMENSIONS = 1 << 17
TRAINED_ON = 20_000  # rows that the scorer is fitted on, by hash


@dataclass
class LabelModel:
    prior: float  # share of class 1
    votes: np.ndarray  # voter, class, vote -> probability
    weights: np.ndarray  # voter -> 1 / (1 + its correlations)
    correlations: np.ndarray  # voter, voter, given the class

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.votes)
        each = np.stack([
            (logs[np.arange(patterns.shape[1]), y][np.arange(patterns.shape[1]), patterns + 1] * self.weights).sum(1)
            for y in (0, 1)
        ])
        odds = each[1] - each[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    @property
    def accuracies(self) -> np.ndarray:
        """Probability that a vote is right, where the voter does not abstain."""
        right = self.prior * self.votes[:, 1, 2] + (1 - self.prior) * self.votes[:, 0, 0]
        voted = right + self.prior * self.votes[:, 1, 0] + (1 - self.prior) * self.votes[:, 0, 2]
        return right / voted


def fit(patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, anchor: np.ndarray | None = None) -> LabelModel:
    """EM from a first guess ``start`` of each pattern's posterior.

    ``anchor``: known (class 0, class 1) counts of each pattern, which always count as known.
    """
    m = patterns.shape[1]
    known = np.zeros((len(patterns), 2)) if anchor is None else anchor
    one_hot = np.stack([patterns == v for v in VALUES], 2).astype(float)
    model = LabelModel(0.5, np.full((m, 2, 3), 1 / 3), np.ones(m), np.eye(m))
    post = start
    for round_ in range(2):
        for _ in range(STEPS):
            share = np.stack([(1 - post) * counts, post * counts]) + known.T
            total = share.sum(1)
            model.prior = float(np.clip((total[1] + 1) / (total.sum() + 2), 1e-4, 1 - 1e-4))
            seen = np.einsum("yp,pmv->myv", share, one_hot) + SMOOTHING
            model.votes = seen / seen.sum(2, keepdims=True)
            post = model.posterior(patterns)
        if round_ == 0:
            model.correlations = _correlations(patterns, np.stack([(1 - post) * counts, post * counts]))
            beyond = np.abs(model.correlations) * (np.abs(model.correlations) > CORRELATED)
            model.weights = 1 / np.maximum(beyond.sum(1), 1)  # the diagonal counts 1
    return model


def _correlations(patterns: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Correlation of the votes within a class, averaged over the classes."""
    out = np.zeros((patterns.shape[1],) * 2)
    for w in share:
        if w.sum() <= 0:
            continue
        mean = w @ patterns / w.sum()
        off = patterns - mean
        cov = (off * w[:, None]).T @ off / w.sum()
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        out += cov / scale / scale[:, None] * w.sum() / share.sum()
    np.fill_diagonal(out, 1)
    return out


def pattern_counts(votes: DataFrame, voters: list[str], known: Column | None = None):
    """Patterns and their counts over all rows, and counts of known labels if given."""
    if len(voters) > MOST_VOTERS:
        raise ValueError(f"at most {MOST_VOTERS} voters")
    labels = [F.count(F.lit(1)).alias("_n")]
    if known is not None:
        labels += [F.sum((known == y).cast("long")).alias(f"_y{y}") for y in (0, 1)]
    rows = votes.groupBy(*voters).agg(*labels).collect()
    patterns = np.array([[r[v] for v in voters] for r in rows], dtype=int).reshape(-1, len(voters))
    counts = np.array([r._n for r in rows], dtype=float)
    anchor = None if known is None else np.array([[r._y0 or 0, r._y1 or 0] for r in rows], dtype=float).reshape(-1, 2)
    return patterns, counts, anchor


def posterior_column(voters: list[str], patterns: np.ndarray, posterior: np.ndarray) -> Column:
    """A lookup of at most 3**m entries as a map literal."""
    key = F.concat_ws(",", *[F.col(v).cast("string") for v in voters])
    names = [",".join(map(str, p)) for p in patterns.tolist()]
    table = F.map_from_arrays(F.lit(names), F.lit([float(x) for x in posterior]))
    return F.element_at(table, key)


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``features``: their ``tokens`` as a sparse vector of zeros and ones."""
    return HashingTF(numFeatures=DIMENSIONS, binary=True, inputCol="tokens", outputCol="features").transform(rows)


def scored(rows: DataFrame, labelled: DataFrame, sparse: float = 0.0) -> DataFrame:
    """``rows`` with ``score``: as ``scored_features``, with a column ``tokens`` on both."""
    out = scored_features(hashed(rows), hashed(labelled.select("tokens", "posterior")), sparse)
    return out.select(*rows.columns, "score")


def scored_features(rows: DataFrame, labelled: DataFrame, sparse: float = 0.0) -> DataFrame:
    """``rows`` with ``score``: a logistic scorer.

    ``rows``: a column ``features``; ``labelled``: ``features`` and ``posterior``, at most
    TRAINED_ON rows of it. Every row trains both classes, weighted by its posterior.
    ``sparse``: share of the penalty on absolute weights. Near 1 it leaves few features,
    which suits a class that a few words of a long text tell.
    """
    spark = rows.sparkSession
    sides = F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")),
    ))
    data = labelled.select("features", sides.alias("side")).select(
        "features", "side.label", "side.weight"
    ).filter("weight > 0.001")
    data = written(data, "scorer-training")
    classes = data.agg(F.min("label").alias("l"), F.max("label").alias("h")).first()
    if classes.l is None or classes.l == classes.h:
        return rows.withColumn("score", F.lit(float(classes.l or 0.0)))
    learner = LogisticRegression(
        maxIter=60 if sparse else 30, regParam=1e-3, elasticNetParam=sparse, weightCol="weight",
        standardization=False,
    )
    model = learner.fit(data.repartition(max(2, spark.sparkContext.defaultParallelism)))
    out = model.transform(rows)
    return out.select(*rows.columns, F.get(vector_to_array("probability"), 1).alias("score"))
