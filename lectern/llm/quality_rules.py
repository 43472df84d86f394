"""Quality rules: base counts, then robust multivariate outliers by minimum-covariance-determinant estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import HOT, STATS, TASK_ROWS, cut, map_column, meet, text_stats

#: Share of a group's rows whose covariance determinant is made small.
COVERAGE = 0.75
#: Starts of the search, and concentration steps that all of them take before the one of the least determinant goes on alone.
STARTS, TRIALS = 3, 2
#: The search ends when no group's logarithm of the determinant changes by more; each step lowers it, so it ends anyway, and after so many steps in all.
STABLE, MOST_STEPS = 0.01, 30
#: Rows at which a group's own estimate weighs as much as the one over all rows.
EVEN = 60
#: Squared distances whose median is above the chi-square median are scaled down to it; beyond this value (a chi-square tail of 5e-7) a row is rejected.
CUTOFF = 40.0
#: Groups whose estimates are broadcast at most (about 0.7 KB each); of more, only those of hot keys.
BROADCAST_GROUPS = 20_000
POOLED = "*"
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Standard deviations that an estimate is held above, by statistic: constant statistics must not make any difference infinite.
FLOORS = (0.06, 0.12, 0.06, 0.12, 0.12, 0.06)
P = len(FLOORS)
_X = [f"x{i}" for i in range(P)]
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_CHI2_MEDIAN = 5.348120627447122  # of 6 degrees of freedom


def transformed(stats: np.ndarray) -> np.ndarray:
    """Variance-stabilised rates: symbols, capitals, repetition by windows and by neighbours, repeated lines, letters a word."""
    g = dict(zip(STATS, np.asarray(stats, float).T.reshape(len(STATS), -1), strict=True))
    n = g["n_words"]
    return np.column_stack([
        np.sqrt(g["n_symbols"] / (n + 10)), np.log((g["word_chars"] + 20) / (n + 4)), np.sqrt(g["n_upper"] / (g["n_letters"] + 40)),
        np.sqrt(g["n_repeat_words"] / (n + 40)), np.sqrt(g["n_dup_lines"] / (g["n_lines"] + 20)), np.sqrt(g["n_adjacent"] / (n + 20)),
    ])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the base counts and the transformed statistics of whole texts. A narrow map."""
    ddl = ", ".join([f"{c} bigint" for c in _BASE] + [f"{x} double" for x in _X])

    def run(batch: list[bytes | None]) -> dict[str, list]:
        if not batch:
            return {c: [] for c in (*_BASE, *_X)}
        s = np.array([text_stats(t) for t in batch], np.int64)
        x = transformed(s)
        return {c: s[:, STATS.index(c)].tolist() for c in _BASE} | {c: x[:, i].tolist() for i, c in enumerate(_X)}

    return map_column(docs.withColumnRenamed(text, "__text"), "__text", ddl, run)


def _precision(cov: np.ndarray) -> tuple[float, list[float]]:
    """Logarithm of the determinant of the floored covariance, and its inverse for _distance()."""
    cov = cov + np.diag(np.square(FLOORS))
    p = np.linalg.inv(cov)
    return float(np.linalg.slogdet(cov)[1]), [float(p[i, j]) * (1 if i == j else 2) for i, j in _PAIRS]


def _covariance(mean: np.ndarray, products: list[float]) -> np.ndarray:
    cov = np.zeros((P, P))
    for (i, j), x in zip(_PAIRS, products, strict=True):
        cov[i, j] = cov[j, i] = x - mean[i] * mean[j]
    return cov


def _own(s: int) -> list[str]:
    """The columns of one start's estimate: determinant, location, covariance, precision."""
    return [f"det{s}", *(f"m{s}_{i}" for i in range(P)), *(f"c{s}_{i}_{j}" for i, j in _PAIRS), *(f"p{s}_{i}_{j}" for i, j in _PAIRS)]


def _ddl(starts: int) -> str:
    return "key string, uses bigint, " + ", ".join(f"{c} double" for s in range(starts) for c in _own(s))


def _entry(mean: np.ndarray, cov: np.ndarray) -> list[float]:
    det, p = _precision(cov)
    return [det, *map(float, mean), *(float(cov[i, j]) for i, j in _PAIRS), *p]


def _map(f):
    """``f`` on each batch of some groups' numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield f(b)

    return run


def _distance(s: int = 0) -> Column:
    d = [F.col(f"x{i}") - F.col(f"m{s}_{i}") for i in range(P)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + F.col(f"p{s}_{i}_{j}") * d[i] * d[j]
    return total


def _with(rows: DataFrame, params: DataFrame, limits: dict[str, int]) -> DataFrame:
    """``rows`` with the columns of ``params``, by key. A key of very many rows, as that of all rows is, is never dealt to one task."""
    if params.count() <= limits["broadcast_groups"]:
        return rows.join(F.broadcast(params.drop("uses")), "key")
    return meet(rows, params, "key", task_rows=limits["task_rows"], hot=limits["hot"])


def _starts(both: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Three covariances that outliers sway little, all about the medians and scaled by the quartiles: diagonal, of spatial signs, and of hyperbolic tangents."""
    quartiles = cut(both.groupBy("key").agg(F.count("*").alias("uses"), *(F.percentile_approx(x, [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i, x in enumerate(_X))), 1)
    scaled = [(F.col(x) - F.col(f"q{i}")[1]) / (F.greatest(F.col(f"q{i}")[2] - F.col(f"q{i}")[0], F.lit(FLOORS[i])) / 1.349) for i, x in enumerate(_X)]
    z = _with(both, quartiles, limits).select("key", *(f"q{i}" for i in range(P)), *(c.alias(f"z{i}") for i, c in enumerate(scaled)))
    z = z.withColumn("norm", F.greatest(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0)), F.lit(1e-12)))
    products = lambda f: [F.avg(f(i) * f(j)) for i, j in _PAIRS]
    signs = [c.alias(f"sign{k}") for k, c in enumerate(products(lambda i: F.col(f"z{i}") / F.sqrt("norm")))]
    bends = [c.alias(f"bend{k}") for k, c in enumerate(products(lambda i: F.tanh(f"z{i}")))]
    sums = z.groupBy("key").agg(F.count("*").alias("uses"), *(F.first(f"q{i}").alias(f"q{i}") for i in range(P)), *signs, *bends)

    def start(b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in b.itertuples(index=False):
            q = np.array([getattr(r, f"q{i}") for i in range(P)])
            mean, scale = q[:, 1], np.diag((q[:, 2] - q[:, 0]) / 1.349)
            row = [r.key, r.uses, *_entry(mean, scale @ scale)]
            for name in ("sign", "bend"):
                c = _covariance(np.zeros(P), [getattr(r, f"{name}{k}") for k in range(len(_PAIRS))])
                d = np.sqrt(np.maximum(np.diag(c), 1e-9))
                row += _entry(mean, scale @ (c / np.outer(d, d)) @ scale)
            out.append(row)
        return pd.DataFrame(out, columns=["key", "uses", *(c for s in range(STARTS) for c in _own(s))])

    return cut(sums.mapInPandas(_map(start), _ddl(STARTS)), 1)


def _concentrated(both: DataFrame, params: DataFrame, starts: int, limits: dict[str, int]) -> DataFrame:
    """A concentration step: the estimates of the COVERAGE of rows that are nearest under the last ones. ``starts``: how many ``params`` has; if it is to be
    the last step of several starts, the result has one, that of the least determinant."""
    measured = _with(both, params, limits).select("key", *_X, *(_distance(s).alias(f"d{s}") for s in range(starts)))
    near = cut(measured.groupBy("key").agg(F.count("*").alias("uses"), *(F.percentile_approx(f"d{s}", COVERAGE, 2000).alias(f"limit{s}") for s in range(starts))), 1)
    sums = []
    for s in range(starts):
        inside = F.col(f"d{s}") <= F.col(f"limit{s}")
        sums += [F.avg(F.when(inside, F.col(x))).alias(f"s{s}_{i}") for i, x in enumerate(_X)]
        sums += [F.avg(F.when(inside, F.col(_X[i]) * F.col(_X[j]))).alias(f"s{s}_{i}_{j}") for i, j in _PAIRS]
    summed = _with(measured, near, limits).groupBy("key").agg(F.count("*").alias("uses"), *sums)

    def estimate(b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in b.itertuples(index=False):
            row = [r.key, r.uses]
            for s in range(starts):
                mean = np.array([getattr(r, f"s{s}_{i}") for i in range(P)])
                row += _entry(mean, _covariance(mean, [getattr(r, f"s{s}_{i}_{j}") for i, j in _PAIRS]))
            out.append(row)
        return pd.DataFrame(out, columns=["key", "uses", *(c for s in range(starts) for c in _own(s))])

    return cut(summed.mapInPandas(_map(estimate), _ddl(starts)), 1)


def _best(params: DataFrame) -> DataFrame:
    """The start of the least determinant (the first of equal ones)."""
    chosen = F.array_min(F.array(*(F.struct(F.col(f"det{s}").alias("det"), F.lit(s).alias("s"), *(F.col(c).alias(n) for c, n in zip(_own(s)[1:], _own(0)[1:], strict=True))) for s in range(STARTS))))
    picked = params.select("key", "uses", chosen.alias("b"))
    return cut(picked.select("key", "uses", F.col("b.det").alias("det0"), *(F.col(f"b.{n}").alias(n) for n in _own(0)[1:])), 1)


def estimates(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """By ``key``, and for all rows under the key POOLED: uses (rows), and location, covariance, precision and determinant of the minimum-covariance-determinant
    estimate.

    Three starts take TRIALS concentration steps; the one of the least determinant goes on until no group's determinant changes. A step takes each group's
    COVERAGE quantile of the distances (a mergeable sketch over all rows) and averages moments below it; no group is gathered."""
    both = rows.select(F.explode(F.array("key", F.lit(POOLED))).alias("key"), *_X)
    params = _starts(both, limits)
    for _ in range(TRIALS):
        params = _concentrated(both, params, STARTS, limits)
    params = _best(params)
    for _ in range(MOST_STEPS):
        better = _concentrated(both, params, 1, limits)
        change = better.join(params.select("key", F.col("det0").alias("was")), "key").agg(F.max(F.abs(F.col("det0") - F.col("was")))).first()[0]
        params = better
        if change is None or change <= STABLE:
            break
    return params


def _shrunk(rows: DataFrame, params: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(key, uses, location, precision, median): each group's estimate, drawn to that over all rows the more, the fewer rows it has; and the median squared distance,
    drawn in the same way."""
    pooled = params.where(F.col("key") == POOLED).first()
    if pooled is None:
        return params.withColumn("median", F.lit(0.0))
    mean0 = np.array([pooled[f"m0_{i}"] for i in range(P)])
    cov0 = [pooled[f"c0_{i}_{j}"] for i, j in _PAIRS]

    def drawn(b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in b.itertuples(index=False):
            w = r.uses / (r.uses + EVEN)
            mean = w * np.array([getattr(r, f"m0_{i}") for i in range(P)]) + (1 - w) * mean0
            cov = _covariance(np.zeros(P), [w * getattr(r, f"c0_{i}_{j}") + (1 - w) * c for (i, j), c in zip(_PAIRS, cov0, strict=True)])
            out.append([r.key, r.uses, *_entry(mean, cov)])
        return pd.DataFrame(out, columns=["key", "uses", *_own(0)])

    drawn_to = cut(params.mapInPandas(_map(drawn), _ddl(1)), 1)
    both = rows.select(F.explode(F.array("key", F.lit(POOLED))).alias("key"), *_X)
    medians = cut(_with(both, drawn_to, limits).groupBy("key").agg(F.percentile_approx(_distance(), 0.5, 2000).alias("median")), 1)
    over_all = medians.where(F.col("key") == POOLED).first()["median"]
    w = F.col("uses") / (F.col("uses") + EVEN)
    return cut(drawn_to.join(medians, "key").withColumn("median", w * F.col("median") + (1 - w) * F.lit(over_all)), 1)


def apply_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", broadcast_groups: int = BROADCAST_GROUPS, task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """A row for each document: id, base counts, base_failed, distance (scaled squared Mahalanobis distance; null if base_failed) and kept.

    base_failed: fewer than 10 words, or more than 20 % of the words in repeated 5-word windows. Groups are by language and source, nulls being values
    of their own; a group's estimate is drawn to that over all rows, evenly at EVEN rows, so a group of any size is judged alike. Null and empty texts have no
    words; texts of any length count whole; ties and equal rows give equal rows; other columns are not read; an empty table gives an empty one. The last
    arguments: groups whose estimates are broadcast at most, and those of meet() beyond."""
    limits = {"broadcast_groups": broadcast_groups, "task_rows": task_rows, "hot": hot}
    key = F.concat(F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit("-")), F.lit("\x1f"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-")))
    rows = cut(statistics(docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), F.col(text).alias("__t")), "__t").withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))
    passed = rows.where(~F.col("base_failed"))
    found = _shrunk(passed, estimates(passed, limits), limits)
    scaled = _distance() * _CHI2_MEDIAN / F.greatest(F.col("median"), F.lit(_CHI2_MEDIAN))
    judged = _with(passed, found, limits).select("doc_id", *_BASE, "base_failed", scaled.alias("distance"))
    failed = rows.where("base_failed").select("doc_id", *_BASE, "base_failed", F.lit(None).cast("double").alias("distance"))
    return judged.unionByName(failed).withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CUTOFF))
