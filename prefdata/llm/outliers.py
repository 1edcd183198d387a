"""Operator 1: quality rules by robust multivariate outliers, DataFrame functions only.

Every text gets a vector of transformed statistics.  For each language and
source a minimum-covariance-determinant estimate of location and scatter is
found by concentration steps, started at the medians and quartile ranges, and
then reweighted; a text whose Mahalanobis distance exceeds the cutoff goes.

The vectors are rounded to a fixed grid, so that all sums and quantiles are
exact integers and the verdicts do not depend on partitioning or lost tasks.
A concentration step is one pass: moments are summed per group and distance
bin, and the bins up to the wanted share of rows are added up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prefdata.llm.common import SPACE_CHARS, materialize, params_by_key, text_words

#: Share of a group's rows that the determinant is minimised over, and concentration steps.
SHARE, STEPS = 0.75, 5
#: Rows that a language and source need for an estimate of their own: ten for each statistic.
#: With fewer, their language's estimate over all its rows stands in, and for a language with fewer that of all rows.
MIN_GROUP = 50
#: Quantile of the chi-square distribution beyond which a row is an outlier, and that of the reweighting step.
CUT, REWEIGHT = 0.99999, 0.975
#: Steps of the grid in one unit; bins per doubling of a squared distance, and their number.
GRID, BINS_PER_DOUBLING, BINS = 1024, 64, 4096
#: Standard deviation below which no statistic is taken to vary (in transformed units).  Each is small enough that
#: the statistic alone can pass the cutoff: shares of lines or words lie between 0 and 1, and 1 / 0.15 exceeds 5.55.
FLOOR = {"x_length": 0.10, "x_symbols": 0.35, "x_lines": 0.15, "x_repeats": 0.12, "x_upper": 0.45}
X = list(FLOOR)

SYMBOLS = "#*$%&|<>"


def base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every text; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    taken = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    window = F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    df = docs.select("doc_id", "lang", "source", text.alias("t"))
    df = df.select("doc_id", "lang", "source", text_words(F.col("t")).alias("w"), lines.alias("l"),
                   F.length(F.translate("t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
                   taken(SYMBOLS).cast("long").alias("n_symbols"),
                   taken("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"))
    df = df.select("*", window.alias("h"))
    # Windows in order of their hash: equal ones are neighbours.
    ordered = F.when(F.size(F.array_distinct("h")) < F.size("h"),
                     F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    df = df.select("*", ordered.alias("o"))
    again = F.filter(F.transform("o", lambda s, k: F.when(
        (F.get("o", k - 1)["h"] == s["h"]) | (F.get("o", k + 1)["h"] == s["h"]), s["i"])), lambda p: p.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(again, lambda p: F.array(p, p + 1, p + 2))))
    return df.select("doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
                     (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                     F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
                     F.size("l").cast("long").alias("n_lines"), "n_upper")


def _vector() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1))
    raw = {"x_length": F.log(F.greatest("word_chars", F.lit(1)) / n), "x_symbols": F.log1p(100 * F.col("n_symbols") / n),
           "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
           "x_repeats": F.sqrt(F.col("n_repeat_words") / n),
           "x_upper": F.log1p(100 * F.col("n_upper") / F.greatest("word_chars", F.lit(1)))}
    return {k: F.round(v * GRID).cast("long") for k, v in raw.items()}


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function (series of the incomplete gamma function)."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    for i in range(1, 1000):
        term *= z / (a + i)
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a)) if z > 0 else 0.0


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return lo


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the innermost share of normal rows consistent."""
    p = len(X)
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _distance() -> Column:
    """Squared Mahalanobis distance by the inverse Cholesky factor w_i_j and the location m_i."""
    total = F.lit(0.0)
    for i in range(len(X)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w_{i}_{j}") * (F.col(X[j]) - F.col(f"m_{j}"))
        total = total + part * part
    return total


def _sums() -> list[Column]:
    return ([F.count("*").alias("n")] + [F.sum(x).alias(f"s_{i}") for i, x in enumerate(X)]
            + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q_{i}_{j}") for i in range(len(X)) for j in range(i + 1)])


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """Moments per group -> location m_i and inverse Cholesky factor w_i_j of the floored covariance."""
    p, n = len(X), F.col("n").cast("double")
    floor = [(FLOOR[x] * GRID) ** 2 for x in X]
    cov = {(i, j): factor * (F.col(f"q_{i}_{j}") / n - (F.col(f"s_{i}") / n) * (F.col(f"s_{j}") / n))
           + (floor[i] if i == j else 0.0) for i in range(p) for j in range(i + 1)}
    df = sums.select("gid", *[(F.col(f"s_{i}") / n).alias(f"m_{i}") for i in range(p)], *[v.alias(f"c_{i}_{j}") for (i, j), v in cov.items()])
    for j in range(p):  # Cholesky factor, column by column
        left = F.col(f"c_{j}_{j}") - sum((F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(left, F.lit(floor[j] * 1e-6))))
        df = df.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0)))
                             / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    for i in range(p):  # its inverse, row by row
        df = df.withColumns({f"w_{i}_{j}": (F.lit(1.0) if i == j else -sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0)))
                             / F.col(f"l_{i}_{i}") for j in range(i + 1)})
    return materialize(df.select("gid", *[f"m_{i}" for i in range(p)], *[f"w_{i}_{j}" for i in range(p) for j in range(i + 1)]), "mcd")


def _with_groups(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the group gid they are judged by, fitting rows of every such group).

    gid is language and source where they have MIN_GROUP fitting rows, else the
    language if it has them, else all rows; null where even those are too few.
    A language's estimate is fitted on all its rows, also on those of groups
    with an estimate of their own, and that of all rows likewise.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    keyed = stats.withColumn("gkey", F.concat_ws("\x1f", part("lang"), part("source"))).withColumn("glang", F.concat(part("lang"), F.lit("\x1f*")))
    sizes = materialize(keyed.groupBy("gkey", "glang").agg(F.count_if(~F.col("base_failed")).alias("gn")), "mcd-groups")
    pools = sizes.groupBy("glang").agg(F.sum("gn").alias("ln"))
    every = sizes.agg(F.coalesce(F.sum("gn"), F.lit(0))).first()[0]
    level = sizes.join(pools, "glang").withColumn(
        "gid", F.when(F.col("gn") >= MIN_GROUP, F.col("gkey")).when(F.col("ln") >= MIN_GROUP, F.col("glang")).when(F.lit(every >= MIN_GROUP), F.lit("*")))
    used = level.filter("gid IS NOT NULL").select("gid").distinct()
    fits = level.select("gkey", F.explode(F.array("gkey", "glang", F.lit("*"))).alias("gid")).join(used, "gid").groupBy("gkey").agg(F.collect_set("gid").alias("fits"))
    level = materialize(level.select("gkey", "gid").join(fits, "gkey", "left"), "mcd-levels")
    rows = materialize(params_by_key(keyed, level, "gkey", F.col("doc_id")).drop("gkey", "glang"), "quality-groups")
    return rows.drop("fits"), rows.filter(~F.col("base_failed")).select("doc_id", F.explode("fits").alias("gid"), *X)


def quality_outliers(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per row of ``docs``: base statistics, ``base_failed``, ``distance`` (squared; null without estimate) and ``kept``.

    Null and empty texts have no words and fail the base rule.  Null languages
    and sources are groups of their own; repeated rows count as often as they
    occur; a group too small to be estimated is judged by its language, else by all
    rows; a table of fewer than ``MIN_GROUP`` fitting rows rejects nobody.
    Extra columns of ``docs`` are not looked at.
    """
    stats = base_stats(docs.select("doc_id", "text", "lang", "source"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = materialize(stats.withColumn("base_failed", failed).withColumns(_vector()), "quality-stats")
    rows, fit = _with_groups(stats)

    quartiles = fit.groupBy("gid").agg(*[F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p_{i}") for i, x in enumerate(X)])
    spread = lambda i: F.greatest((F.col(f"p_{i}")[2] - F.col(f"p_{i}")[0]) / 1.349, F.lit(FLOOR[X[i]] * GRID))
    params = quartiles.select("gid", *[F.col(f"p_{i}")[1].alias(f"m_{i}") for i in range(len(X))],
                              *[(1 / spread(i) if i == j else F.lit(0.0)).alias(f"w_{i}_{j}") for i in range(len(X)) for j in range(i + 1)])
    params = materialize(params, "mcd")
    for _ in range(STEPS):
        d2 = params_by_key(fit, params, "gid", F.col("doc_id"), "inner").withColumn("d2", _distance())
        bins = F.least(F.floor(F.log2(1 + F.col("d2")) * BINS_PER_DOUBLING), F.lit(BINS - 1)).alias("bin")
        hist = d2.groupBy("gid", bins).agg(*_sums())
        upto = Window.partitionBy("gid").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("below", F.sum("n").over(upto) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy("gid")))
        inner = hist.filter(F.col("below") < SHARE * F.col("all"))
        moments = [c for c in hist.columns if c == "n" or c[:2] in ("s_", "q_")]
        params = _estimate(inner.groupBy("gid").agg(*[F.sum(c).alias(c) for c in moments]), _consistency(SHARE))
    near = params_by_key(fit, params, "gid", F.col("doc_id"), "inner").filter(_distance() <= chi2_quantile(REWEIGHT, len(X)))
    params = _estimate(near.groupBy("gid").agg(*_sums()), _consistency(REWEIGHT))
    scored = params_by_key(rows, params, "gid", F.col("doc_id")).withColumn("distance", _distance())
    inside = F.coalesce(F.col("distance") <= chi2_quantile(cut, len(X)), F.lit(True))
    return scored.withColumn("kept", ~F.col("base_failed") & inside).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance",
        "lang", "source", *X)
