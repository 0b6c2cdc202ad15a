"""Quality rules and robust multivariate outliers of document statistics.

Every whole text gives five statistics: log of its words, log of the mean word length, and the square roots of symbols
per word, of repeated lines per line and of repeated words per word. Per language and source their
centre and scatter are estimated by the minimum covariance determinant over all documents with a word. Two
deterministic starts (coordinate medians with their deviations, and the scatter of squashed scores) take concentration
steps: the ``COVER`` share of documents nearest by Mahalanobis distance gives the next centre and scatter. The start with the
smaller determinant wins, is reweighted once, and rejects documents whose squared distance passes a chi-square
quantile.

Each step is two aggregations over all rows that join one small row of estimates per group; the share is found from
exact counts of finely binned distances, so a group of a third of all rows is counted before it moves.
``FLOORS`` is added to the scatter: spreads below it, such as those of a statistic that is
zero nearly everywhere, are no ground for rejection.

Edge cases: null and empty texts have no words and fail the base rules; null language or source form groups of
their own; a group of few documents has a scatter near the floors and rejects only what is far off;
repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import (
    ascii_words, chi_square_cdf, chi_square_quantile, few, run_batches, stored,
)

STATS = ("x0", "x1", "x2", "x3", "x4")
FLOORS = (0.5, 0.12, 0.12, 0.15, 0.1)
COVER = 0.75
STEPS = 4
QUANTILE = 0.99999
SYMBOLS = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
BINS = 64  # per doubling of a squared distance


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words in runs of ``width`` that occur twice or more, the first included."""
    known: dict[bytes, int] = {}
    if len(words) <= width:
        return 0
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    runs = len(words) - width + 1
    code, bound = ids[:runs].copy(), len(known)
    for step in range(1, width):
        if bound * len(known) >= 1 << 62:
            found, code = np.unique(code, return_inverse=True)
            bound = len(found)
        code = code * len(known) + ids[step : step + runs]
        bound *= len(known)
    _, which, count = np.unique(code, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(count[which] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the number of lines with a word."""
    text = text or ""
    words = ascii_words(text)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words), len(text) - sum(text.count(x) for x in BLANKS), sum(text.count(x) for x in SYMBOLS[1:-1]),
        len(lines) - len(set(lines)), repeat_words(words), len(lines),
    )


def _rows(batches):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    for batch in batches:
        found = [base_stats(text) for text in batch["text"]]
        out = {"doc_id": batch["doc_id"], "lang": batch["lang"], "source": batch["source"]}
        for i, name in enumerate(names):
            out[name] = [x[i] for x in found]
        yield out


def statistics(docs: DataFrame, min_words: int = 10, max_repeated: int = 20) -> DataFrame:
    """Base counts, ``base_failed``, the group and the transformed statistics of every document."""
    counted = run_batches(docs.select("doc_id", "lang", "source", "text"), _rows, (
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_lines long"))
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("0"))
    share = lambda a, b: f"coalesce(sqrt({a} / nullif({b}, 0)), 0d)"
    return counted.select(
        "*", F.xxhash64(F.concat(name("lang"), F.lit("\x00"), name("source"))).alias("g"),
        F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {max_repeated} * n_words").alias("base_failed"),
        F.expr("log1p(n_words)").alias("x0"), F.expr("coalesce(ln(word_chars / nullif(n_words, 0)), 0d)").alias("x1"),
        F.expr(share("n_symbols", "n_words")).alias("x2"), F.expr(share("n_dup_lines", "n_lines")).alias("x3"),
        F.expr(share("n_repeat_words", "n_words")).alias("x4"))


PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]
SHAPE = "g long, start int, logdet double, " + ", ".join(
    [f"c{i} double" for i in range(5)] + [f"p{i}{j} double" for i, j in PAIRS])


def _estimate(factor: float, floors):
    """Row function: sums of a group to its centre and inverse scatter."""

    def rows(frames):
        for frame in frames:
            out = []
            for r in frame.itertuples():
                n = r.n
                mean = np.array([getattr(r, f"s{i}") for i in range(5)]) / n
                cov = np.zeros((5, 5))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = getattr(r, f"q{i}{j}") / n - mean[i] * mean[j]
                centre = np.array([getattr(r, f"b{i}") for i in range(5)]) + mean * np.array([getattr(r, f"k{i}") for i in range(5)])
                scale = np.array([getattr(r, f"k{i}") for i in range(5)])
                cov = cov * factor * np.outer(scale, scale) + np.diag(np.square(floors))
                inverse = np.linalg.inv(cov)
                out.append([r.g, r.start, float(np.linalg.slogdet(cov)[1]), *centre, *[inverse[i, j] for i, j in PAIRS]])
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SHAPE.split(", ")])

    return rows


def _scatter(rows: DataFrame, values, base, scale, factor: float, name: str) -> DataFrame:
    """Estimates per ``g, start`` from the rows, where a statistic is ``base + scale * value``."""
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    sums += [F.sum(values[i] * values[j]).alias(f"q{i}{j}") for i, j in PAIRS]
    sums += [F.first(x).alias(f"b{i}") for i, x in enumerate(base)] + [F.first(x).alias(f"k{i}") for i, x in enumerate(scale)]
    found = rows.groupBy("g", "start").agg(F.count("*").alias("n"), *sums)
    return stored(found.mapInPandas(_estimate(factor, FLOORS), SHAPE), name)


def _distance() -> Column:
    parts = [f"{1 if i == j else 2} * p{i}{j} * (x{i} - c{i}) * (x{j} - c{j})" for i, j in PAIRS]
    return F.greatest(F.expr(" + ".join(parts)), F.lit(0.0))


def _measured(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    return stats.join(few(estimates, 300), "g").withColumn("d2", _distance())


def minimum_covariance(stats: DataFrame, cover: float = COVER, steps: int = STEPS) -> DataFrame:
    """Reweighted estimates, one row per group, from the stored rows ``g, x0..x4``."""
    zeros, ones = [F.lit(0.0)] * 5, [F.lit(1.0)] * 5
    medians = stored(stats.groupBy("g").agg(*[F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(STATS)]), "medians")
    apart = stats.join(few(medians, 80), "g")
    spreads = apart.groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(5)],
        *[F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5), F.lit(FLOORS[i])).alias(f"w{i}") for i in range(5)])
    spreads = stored(spreads, "spreads")
    scored = stats.join(few(spreads, 120), "g")
    squashed = [F.expr(f"tanh((x{i} - m{i}) / w{i})") for i in range(5)]
    start1 = _scatter(scored.withColumn("start", F.lit(1)), squashed,
                      [F.col(f"m{i}") for i in range(5)], [F.col(f"w{i}") for i in range(5)], 1.0, "start")
    start0 = spreads.select(
        "g", F.lit(0).alias("start"), F.expr(" + ".join(f"2 * ln(w{i})" for i in range(5))).alias("logdet"),
        *[F.col(f"m{i}").alias(f"c{i}") for i in range(5)],
        *[(F.expr(f"1 / (w{i} * w{i})") if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in PAIRS])
    estimates = stored(start0.union(start1), "starts")
    # What the covered share of a normal sample lacks in spread.
    edge = chi_square_quantile(cover, 5)
    covered = cover / chi_square_cdf(edge, 7)
    values = [F.col(x) for x in STATS]
    step_bin = F.floor(F.log2(F.col("d2") + 2.0**-20) * BINS)
    running = Window.partitionBy("g", "start").orderBy("bin")
    whole = Window.partitionBy("g", "start")
    for _ in range(steps):
        measured = _measured(stats, estimates).withColumn("bin", step_bin)
        bins = measured.groupBy("g", "start", "bin").agg(F.count("*").alias("k"))
        cut = (
            bins.withColumn("upto", F.sum("k").over(running)).withColumn("all", F.sum("k").over(whole))
            .where(F.col("upto") >= cover * F.col("all")).groupBy("g", "start").agg(F.min("bin").alias("cut"))
        )
        inner = measured.join(few(stored(cut, "cut"), 24), ["g", "start"]).where("bin <= cut")
        estimates = _scatter(inner, values, zeros, ones, covered, "step")
    best = estimates.groupBy("g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    chosen = stored(estimates.join(best, ["g", "start"]), "chosen")
    near = chi_square_quantile(0.975, 5)
    inner = _measured(stats, chosen).where(F.col("d2") <= near)
    final = _scatter(inner, values, zeros, ones, 0.975 / chi_square_cdf(near, 7), "final")
    # A group without a row that near keeps its covered estimate.
    return stored(final.union(chosen.join(final.select("g"), "g", "left_anti").select(final.columns)), "estimates")


def judge(docs: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """One row per document: base counts, ``base_failed``, squared ``distance`` and ``kept``."""
    stats = stored(statistics(docs), "stats")
    estimates = minimum_covariance(stats.where("n_words > 0").select("g", *STATS))
    known = stats.join(few(estimates, 300), "g", "left").withColumn("distance", F.when(F.col("n_words") > 0, _distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_square_quantile(quantile, 5), F.lit(False))
    return known.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "distance")
