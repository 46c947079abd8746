"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Beside two fixed rules, a document goes if its statistics are unlike those of
its language and source. Five transformed statistics form a vector. Their
centre and covariance are minimum-covariance-determinant estimates: from a
start at medians and absolute deviations, concentration steps re-estimate both
on the ``HALF`` of each group that lies nearest. A squared Mahalanobis distance
of the statistics but the length, above the chi-square cutoff, rejects: a long
clean text is no outlier, and a short one is a matter of the base rules.

A group's moments are blended with those of its language, and these with those
of all documents, as ``PRIOR`` pseudo-documents, so a small group needs no rule
of its own. Variances have floors (``FLOOR``), as most clean documents have no
symbols or repeats at all and would otherwise make any such document an outlier.

Only a row per group leaves an aggregation, whose minima, sums and percentile
sketches combine before the shuffle; a hot source is no hot task. Documents get
their group's estimates by a join that Spark broadcasts by measured size.

Cases: null text has no words and fails the base rules, as does any text below
50 words; null language or source is a group of its own; repeated rows each
get a row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import WORD, stored, words_of

# the length comes last: it takes part in the estimates, and the verdict's distance ends before it
STATISTICS = ("wide", "symbols", "lines", "repeats", "long")
FLOOR = (0.4, 0.7, 0.7, 0.06, 0.5)
HALF = 0.75
STEPS = 3
PRIOR = 30.0
REJECT = 1e-4


def chi2_cdf(x: float, k: int) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < p else (low, middle)
    return high


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as fields of ``__stats``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.withColumns({"__text": text, "__words": words_of(F.col("text").cast("string"))})
    words, n = F.col("__words"), F.size("__words")
    three = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))),
        lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD))
    hashed = split.withColumns({
        "__windows": F.when(n >= 3, three).otherwise(F.array().cast("array<bigint>")), "__lines": lines})
    windows = F.col("__windows")
    # windows by hash and place, only for texts that repeat one
    ordered = hashed.withColumn("__ordered", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    pairs = F.filter(
        F.zip_with(
            F.slice("__ordered", F.lit(1), F.size("__ordered") - 1),
            F.slice("__ordered", F.lit(2), F.size("__ordered") - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
        lambda pair: pair.isNotNull())
    starts = F.sort_array(F.array_distinct(F.flatten(pairs)))
    # a window adds the words that the one before doesn't cover
    covered = F.aggregate(
        starts, F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda done, at: F.struct(at.alias("at"), (done["n"] + F.least(F.lit(3), at - done["at"])).alias("n")),
        lambda done: done["n"])
    stats = F.struct(
        n.cast("long").alias("n_words"), F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    # exploding an array of one keeps the optimizer from repeating all this for every use of a statistic
    return ordered.select(*[docs[c] for c in docs.columns], F.explode(F.array(stats)).alias("__stats"))


def base_failed() -> Column:
    n = F.col("__stats.n_words")
    return (n < 50) | (100 * F.col("__stats.n_repeat_words") > 50 * n)


def _vector() -> list[Column]:
    """The transformed statistics; null where the base rules fail, as such rows are no part of the estimates."""
    s = {name: F.col(f"__stats.{name}").cast("double") for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    n = F.when(~base_failed(), s["n_words"])
    return [
        s["word_chars"] / n, F.log1p(100 * s["n_symbols"] / n), F.log1p(1000 * s["n_dup_lines"] / n),
        s["n_repeat_words"] / n, F.log(n)]


def _group(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def with_vector(docs: DataFrame) -> DataFrame:
    named = {f"__{s}": x for s, x in zip(STATISTICS, _vector())}
    return docs.withColumns(named | {"__lang": _group("lang"), "__source": _group("source")})


def _x(i: int) -> Column:
    return F.col(f"__{STATISTICS[i]}")


P = len(STATISTICS)
JUDGED = P - 1
GROUP = ["__lang", "__source"]
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def distance(first: int = P) -> Column:
    """Squared Mahalanobis distance of the first statistics: m0.. the joined centre, w10.. the inverse Cholesky factor."""
    rows = []
    for i in range(first):
        rows.append(reduce(lambda a, b: a + b, (F.col(f"w{i}{j}") * (_x(j) - F.col(f"m{j}")) for j in range(i + 1))))
    return reduce(lambda a, b: a + b, (r * r for r in rows))


def _start(vectors: DataFrame) -> DataFrame:
    """Medians, and spreads from the middle half, as a diagonal estimate."""
    found = vectors.groupBy(*GROUP).agg(*(
        F.percentile_approx(_x(i), [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)))
    columns = [F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)]
    for i, j in _LOWER:
        # a normal distribution's middle half spans 1.349 deviations
        spread = F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOOR[i]))
        columns.append((1 / spread if i == j else F.lit(0.0)).alias(f"w{i}{j}"))
    return found.select(*GROUP, *columns)


def _moments(nearest: DataFrame) -> DataFrame:
    """Centre and covariance of each group, blended with its language and with all."""
    sums = ["n", *(f"s{i}" for i in range(P)), *(f"c{i}{j}" for i, j in _LOWER)]
    groups = stored(nearest.groupBy(*GROUP).agg(
        F.count(F.lit(1)).cast("double").alias("n"), *(F.sum(_x(i)).alias(f"s{i}") for i in range(P)),
        *(F.sum(_x(i) * _x(j)).alias(f"c{i}{j}") for i, j in _LOWER)), "moments")

    def means(df: DataFrame, to: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in sums], *((F.col(c) / F.col("n")).alias(f"{to}{c}")
                         for c in sums[1:]), F.col("n").alias(f"{to}n"))

    def total(*keys: str) -> DataFrame:
        return groups.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))

    # one row of all documents meets the rows of groups: no growing side
    nested = means(groups, "g_").join(means(total("__lang"), "l_"), "__lang").join(
        means(total(), "a_").withColumn("__one", F.lit(1)).hint("broadcast"), F.col("__one") == 1)

    def blend(c: str) -> Column:
        language = (F.col("l_n") * F.col(f"l_{c}") + PRIOR * F.col(f"a_{c}")) / (F.col("l_n") + PRIOR)
        return (F.col("g_n") * F.col(f"g_{c}") + PRIOR * language) / (F.col("g_n") + PRIOR)

    blended = nested.select(*GROUP, *(blend(c).alias(c) for c in sums[1:]))
    factor = HALF / chi2_cdf(chi2_quantile(HALF, P), P + 2)
    covariance = [
        F.greatest(factor * (F.col(f"c{i}{i}") - F.col(f"s{i}") ** 2), F.lit(FLOOR[i] ** 2)).alias(f"v{i}{i}") if i == j
        # the floor is added to a diagonal that may be smaller, so the matrix stays positive definite
        else (factor * (F.col(f"c{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}"))).alias(f"v{i}{j}") for i, j in _LOWER]
    return blended.select(*GROUP, *(F.col(f"s{i}").alias(f"m{i}") for i in range(P)), *covariance)


def _inverse_factor(estimates: DataFrame) -> DataFrame:
    """Cholesky factor of v and its inverse w, entry by entry over the few rows of groups."""
    df = estimates
    for i in range(P):
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"v{i}{j}"))
            df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i + 1):
            done = [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)]
            df = df.withColumn(
                f"w{i}{j}", 1 / F.col(f"l{i}{i}") if i == j else -reduce(lambda a, b: a + b, done) / F.col(f"l{i}{i}"))
    return df.select(*GROUP, *(f"m{i}" for i in range(P)), *(f"w{i}{j}" for i, j in _LOWER))


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """Per group: __lang, __source, centre m0.., inverse factor w00.. of the robust covariance."""
    vectors = stored(vectors.where(_x(0).isNotNull()).select(*GROUP, *(_x(i) for i in range(P))), "vectors")
    estimates = stored(_start(vectors), "estimates")
    for _ in range(STEPS):
        far = vectors.join(estimates, GROUP).select(*vectors.columns, distance().alias("__d"))
        limits = far.groupBy(*GROUP).agg(F.percentile_approx("__d", HALF, 1000).alias("__limit"))
        nearest = far.join(limits, GROUP).where("__d <= __limit")
        estimates = stored(_inverse_factor(_moments(nearest)), "estimates")
    return estimates


def _verdict(docs: DataFrame, estimates: DataFrame) -> DataFrame:
    cutoff = chi2_quantile(1 - REJECT, JUDGED)
    return docs.join(estimates, GROUP, "left").withColumns({
        "__failed": base_failed(), "__distance": distance(JUDGED)}).withColumn(
        "__kept", ~F.col("__failed") & (F.coalesce("__distance", F.lit(0.0)) <= cutoff))


def quality(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, its base statistics, base_failed, kept, distance."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    rows = stored(with_vector(with_statistics(narrow)).drop("text", "lang", "source"), "statistics")
    return _verdict(rows, robust_estimates(rows)).select(
        "doc_id", "__stats.*", F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"),
        F.col("__distance").alias("distance"))


def of_quality(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Statistics are taken twice, for the estimates and for the verdict; so texts
    are never shuffled nor stored.
    """
    measured = with_vector(with_statistics(docs))
    return _verdict(measured, robust_estimates(measured)).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])
