"""Quality rules: base limits and robust multivariate outliers, with DataFrame functions only.

Documents that pass the base limits are described by transformed statistics. For each
language and source a minimum-covariance-determinant estimate of location and scatter is
found by concentration steps: keep the documents with the smallest distances, estimate
again, repeat until the determinant falls no more. Steps go from several starts, and the
least determinant wins; all documents near that estimate then give the final one. A document
whose Mahalanobis distance exceeds the limit is rejected.

Statistics are whole numbers of 1/SCALE and are summed as decimals, and the subset is cut at
a bin of a histogram of the distances, so that a rerun gives the same verdicts and a hot
group is summed in every map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orgkin.llm.common import SPACES, documents, words, written

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = (50, 100)
SCALE = 10_000
SUBSET = 0.75  # share of a group that its estimate rests on
DRAWS = 4  # starts from a few documents each, beside those from medians and from all documents
DRAWN = 5  # documents of such a start: one more than there are statistics
BINS = 32  # bins of the distance for each factor of e
NEAR = 11.143  # documents up to here give the final estimate; 0.975 of a normal sample
LIMIT = 170.0  # rejected above; the squared distance of clean documents has median 3 to 4
LEAST_GROUP = 200  # smaller groups are pooled by language, then over all
LEAST_FIT = 30  # below this many documents in all nothing is rejected as an outlier
#: Smallest standard deviation of each statistic: most documents have no symbol at all.
FLOORS = {"_x0": 0.06, "_x1": 0.03, "_x2": 0.15, "_x3": 0.12}
STATS = tuple(FLOORS)


def base_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the base statistics of every whole text.

    For repeated words, the 3-word windows are sorted with their places, those equal to a
    neighbour are kept, and their places, sorted again, are merged: a window adds the words
    that the one before it lacks. That takes O(n log n) for n words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    start = docs.select(
        "doc_id", "lang", "source",
        F.length(solid).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("_lines"),
        F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("_hashed"),
    )
    n = F.size("_hashed")
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(F.get("_hashed", i), F.get("_hashed", i + 1), F.get("_hashed", i + 2)).alias("w"),
            i.alias("at"),
        ),
    )).otherwise(F.array().cast("array<struct<w:bigint,at:int>>"))
    sorted_ = start.withColumn("_windows", F.sort_array(windows))
    twice = F.filter("_windows", lambda e, j: (
        (F.get("_windows", j - 1)["w"] == e["w"]) | (F.get("_windows", j + 1)["w"] == e["w"])
    ))
    placed = sorted_.withColumn("_at", F.sort_array(F.transform(twice, lambda e: e["at"])))
    adds = F.transform("_at", lambda v, j: F.least(
        F.lit(3), v - F.coalesce(F.get("_at", j - 1), F.lit(-3))
    ))
    total = F.aggregate(adds, F.lit(0), lambda a, b: a + b)
    return placed.select(
        "doc_id", "lang", "source", n.cast("long").alias("n_words"),
        "word_chars", "n_symbols", "n_dup_lines",
        total.cast("long").alias("n_repeat_words"), "_lines",
    )


def _numbers(stats: DataFrame) -> DataFrame:
    """Transformed statistics as whole numbers of 1/SCALE, and the base verdict."""
    share, whole = MOST_REPEATED
    failed = (F.col("n_words") < LEAST_WORDS) | (
        whole * F.col("n_repeat_words") > share * F.col("n_words")
    )
    n, c = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = {
        "_x0": F.log(c / n),
        "_x1": F.sqrt(F.col("n_symbols") / c),
        "_x2": F.sqrt(F.col("n_dup_lines") / F.greatest("_lines", F.lit(1))),
        "_x3": F.sqrt(F.col("n_repeat_words") / n),
    }
    return stats.withColumn("base_failed", failed).withColumns(
        {k: F.round(v * SCALE).cast("long") for k, v in values.items()}
    )


def _grouped(table: DataFrame) -> DataFrame:
    """Adds ``_group``: language and source where they hold enough documents, else the
    language, else all; null is a value of its own."""
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    table = table.withColumns({"_lang": lang, "_both": F.concat_ws("\x01", lang, source)})
    fit = table.filter(~F.col("base_failed"))
    counts = fit.groupBy("_both", "_lang").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < LEAST_GROUP
    of_lang = F.sum(F.when(small, F.col("_n"))).over(W.partitionBy("_lang"))
    group = F.when(~small, F.col("_both")).when(of_lang >= LEAST_GROUP, F.col("_lang")).otherwise("")
    names = counts.select("_both", group.alias("_group"))
    return table.join(names, "_both", "left").drop("_both", "_lang")


def _estimate(rows: DataFrame) -> DataFrame:
    """Location and scatter of each group's rows, by start; exact sums."""
    d = lambda c: c.cast("decimal(38,0)")
    sums = [F.count(F.lit(1)).alias("_n")]
    pairs = [(a, b) for i, a in enumerate(STATS) for b in STATS[i:]]
    sums += [F.sum(d(F.col(a))).cast("double").alias(f"s{a}") for a in STATS]
    sums += [F.sum(d(F.col(a) * F.col(b))).cast("double").alias(f"s{a}{b}") for a, b in pairs]
    est = rows.groupBy("_group", "_start").agg(*sums)
    est = est.withColumns({f"m{a}": F.col(f"s{a}") / F.col("_n") for a in STATS})
    cov = {}
    for a, b in pairs:
        value = F.col(f"s{a}{b}") / F.col("_n") - F.col(f"m{a}") * F.col(f"m{b}")
        if a == b:
            value = F.greatest(value, F.lit(0.0)) + (FLOORS[a] * SCALE) ** 2
        cov[f"c{a}{b}"] = value
    return _factor(est.withColumns(cov)).select("_group", "_start", *_FITTED)


def _factor(est: DataFrame) -> DataFrame:
    """Cholesky factor ``l`` of the scatter, a column for each entry, and ``_det``, the
    logarithm of the determinant."""
    for j, a in enumerate(STATS):
        done = [F.col(f"l{a}{k}") for k in STATS[:j]]
        pivot = F.col(f"c{a}{a}") - sum((x * x for x in done), F.lit(0.0))
        est = est.withColumn(f"l{a}{a}", F.sqrt(F.greatest(pivot, F.lit(1.0))))
        est = est.withColumns({
            f"l{b}{a}": (F.col(f"c{a}{b}") - sum(
                (F.col(f"l{b}{k}") * F.col(f"l{a}{k}") for k in STATS[:j]), F.lit(0.0)
            )) / F.col(f"l{a}{a}")
            for b in STATS[j + 1:]
        })
    return est.withColumn("_det", sum((2 * F.log(F.col(f"l{a}{a}")) for a in STATS), F.lit(0.0)))


_FITTED = [f"m{a}" for a in STATS] + [f"l{b}{a}" for i, a in enumerate(STATS) for b in STATS[i:]] + ["_det"]


def _starts(rows: DataFrame) -> DataFrame:
    """Where the steps of each group begin: at the medians, with the floors (0) and with the
    median deviations (1) as scatter; at all its documents (2); and at DRAWS times DRAWN of
    them, picked by a hash of their statistics."""
    fitted = rows.groupBy("_group").agg(*[F.percentile(a, F.lit(0.5)).alias(f"m{a}") for a in STATS])
    fitted = written(fitted, "quality-medians")
    away = rows.join(fitted, "_group").groupBy("_group").agg(
        *[F.percentile(F.abs(F.col(a) - F.col(f"m{a}")), F.lit(0.5)).alias(f"d{a}") for a in STATS]
    )

    def diagonal(est: DataFrame, start: int, of: dict[str, Column]) -> DataFrame:
        scatter = {f"c{a}{b}": of[a] if a == b else F.lit(0.0) for i, a in enumerate(STATS) for b in STATS[i:]}
        return _factor(est.withColumns(scatter)).select("_group", F.lit(start).alias("_start"), *_FITTED)

    floors = {a: F.lit((FLOORS[a] * SCALE) ** 2) for a in STATS}
    spread = {a: floors[a] + (1.4826 * F.col(f"d{a}")) ** 2 for a in STATS}
    turn = F.explode(F.sequence(F.lit(3), F.lit(2 + DRAWS))).alias("_start")
    dealt = rows.select("*", turn).withColumn("_hash", F.xxhash64("_start", *STATS))
    place = F.row_number().over(W.partitionBy("_group", "_start").orderBy("_hash", *STATS))
    drawn = dealt.withColumn("_place", place).filter(F.col("_place") <= DRAWN)
    return (
        diagonal(fitted, 0, floors)
        .unionByName(diagonal(fitted.join(away, "_group"), 1, spread))
        .unionByName(_estimate(rows.withColumn("_start", F.lit(2))))
        .unionByName(_estimate(drawn))
    )


def _concentrated(rows: DataFrame) -> DataFrame:
    """The estimate of least determinant of each group, over all starts and steps. A start ends
    when a step lowers its determinant no more, or meets that of another start."""
    est = written(_starts(rows), "quality-estimate").withColumn("_det", F.lit(float("inf")))
    found = None
    while True:
        far = _distances(rows, est)
        cut = written(_cut(far, SUBSET), "quality-cut")  # of known size, so rows are not shuffled to meet it
        near = far.join(cut, ["_group", "_start"]).filter(_bin(F.col("_d2")) <= F.col("_cut"))
        made = written(_estimate(near), "quality-estimate")
        before = est.select("_group", "_start", F.col("_det").alias("_before"))
        lower = made.join(before, ["_group", "_start"]).filter(F.col("_det") < F.col("_before") - 1e-9)
        found = lower.drop("_before") if found is None else found.unionByName(lower.drop("_before"))
        first = F.row_number().over(W.partitionBy("_group", F.round("_det", 9)).orderBy("_start"))
        est = written(lower.withColumn("_place", first).filter("_place = 1").drop("_place", "_before"), "quality-lower")
        if est.isEmpty():
            break
    least = F.row_number().over(W.partitionBy("_group").orderBy("_det", "_start"))
    return found.withColumn("_place", least).filter("_place = 1").drop("_place")


def _scale(rows: DataFrame, est: DataFrame) -> DataFrame:
    """``_group, _unit, _size``: what a distance is divided by, and the documents of the group.

    A 4-dimensional normal sample has median squared distance 3.357."""
    cut = _cut(_distances(rows, est), 0.5)
    median = F.exp((F.col("_cut") + 1) / BINS)
    return cut.select("_group", (F.greatest(median, F.lit(1.0)) / 3.357).alias("_unit"), "_size")


def _distances(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Adds ``_d2``, the squared Mahalanobis distance, by forward substitution."""
    out = rows.join(est, "_group", "left")
    for i, a in enumerate(STATS):
        above = sum((F.col(f"l{a}{k}") * F.col(f"z{k}") for k in STATS[:i]), F.lit(0.0))
        out = out.withColumn(f"z{a}", (F.col(a) - F.col(f"m{a}") - above) / F.col(f"l{a}{a}"))
    d2 = sum((F.col(f"z{a}") * F.col(f"z{a}") for a in STATS), F.lit(0.0))
    return out.select(*rows.columns, "_start", d2.alias("_d2"))


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-6) * BINS).cast("int")


def _cut(rows: DataFrame, share: float) -> DataFrame:
    """For each group and start the first bin of the distance that completes ``share`` of its rows."""
    keys = ["_group", "_start"]
    bins = rows.groupBy(*keys, _bin(F.col("_d2")).alias("_bin")).agg(F.count(F.lit(1)).alias("_c"))
    seen = F.sum("_c").over(W.partitionBy(*keys).orderBy("_bin"))
    total = F.sum("_c").over(W.partitionBy(*keys))
    return (
        bins.withColumn("_seen", seen).withColumn("_total", total)
        .filter(F.col("_seen") >= F.col("_total") * share)
        .groupBy(*keys).agg(F.min("_bin").alias("_cut"), F.max("_total").alias("_size"))
    )


def _fitting(grouped: DataFrame) -> DataFrame:
    """The documents that estimates rest on. Those left over (group "") are judged by all
    documents where they are too few for an estimate of their own."""
    rows = grouped.filter(~F.col("base_failed")).select("_group", *STATS)
    left = rows.filter("_group = ''").limit(LEAST_GROUP).count()
    if 0 < left < LEAST_GROUP:
        rows = rows.unionByName(rows.filter("_group <> ''").withColumn("_group", F.lit("")))
    return rows


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, the base statistics, ``base_failed``, ``kept``, and
    the squared distance ``outlier_d2`` (null where the base limits failed).

    A null or empty text has no words and fails. Null languages and sources are groups of
    their own; equal rows get equal verdicts; other columns are ignored. An empty table
    gives no rows. With fewer than LEAST_FIT documents in all nothing is an outlier.
    """
    table = written(_numbers(base_statistics(docs)), "quality-statistics")
    grouped = written(_grouped(table), "quality-groups")
    rows = _fitting(grouped)
    est = written(_concentrated(rows), "quality-estimate")
    size = written(_scale(rows, est), "quality-scale")
    near = _distances(rows, est).join(size, "_group").filter(F.col("_d2") <= NEAR * F.col("_unit"))
    est = written(_estimate(near), "quality-estimate")
    size = written(_scale(rows, est), "quality-scale")
    judged = _distances(grouped, est).join(size, "_group", "left")
    d2 = F.when(~F.col("base_failed"), F.col("_d2") / F.col("_unit"))
    kept = ~F.col("base_failed") & (
        (F.coalesce("_size", F.lit(0)) < LEAST_FIT) | (F.coalesce(d2, F.lit(0.0)) <= LIMIT)
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), d2.alias("outlier_d2"),
    )


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    Rows that share an id, a null one too, are kept if one of them is kept.
    """
    kept = quality_rules(docs).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_kept_id")), "left_semi")


def query(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))
