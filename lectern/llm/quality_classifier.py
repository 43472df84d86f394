"""Document quality by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_ROWS, STATS, cut, map_column, narrow_batches, text_stats, unused

#: The score that stands for the threshold quantile.
ACCEPT = 0.3
#: Standardised features lie within this.
CLIP = 6
#: Places of a score w.x: sums come in any order, so what lies beyond is noise, and equal texts are to score equal.
PLACES = 9
#: Steps of the grid on which rows meet all rows of the other label: a pair's probability is taken by linear interpolation, within 0.024 / GRID ** 2 of its own.
GRID = 64
#: The same for the curvature, which only sets how fast the steps come to rest.
COARSE = 4
#: Looks at all rows until the weights are stable; convex, so about 10 do.
LOOKS = 100
#: Buckets of a score's range in one look for the threshold.
BUCKETS = 1 << 16


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def voted_labels(labels: DataFrame, doc_id: str, label: str, allowed: Column) -> DataFrame:
    """(__id, __label): the majority label (a tie counts as 1) of each id that ``allowed`` lets in."""
    return labels.where(allowed & F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg((F.avg(label) >= 0.5).cast("int").alias("__label"))


def training_labels(labels: DataFrame, doc_id: str, label: str, allowed: Column, rows: int) -> DataFrame:
    """At most ``rows`` of voted_labels(), in order of a hash of the id."""
    return voted_labels(labels, doc_id, label, allowed).orderBy(F.xxhash64(F.col("__id")), "__id").limit(rows)


def features(stats: np.ndarray) -> np.ndarray:
    """Rates and hinges from rows of text_stats(); no language, source, id or label."""
    g = dict(zip(STATS, np.asarray(stats, float).T.reshape(len(STATS), -1), strict=True))
    n, chars = g["n_words"], g["word_chars"]
    return np.column_stack([
        np.log1p(n), np.sqrt(g["n_symbols"] / (n + 5)), np.minimum(g["n_symbols"] / (n + 5), 1), np.sqrt(g["n_upper"] / (g["n_letters"] + 20)), g["n_upper"] / (g["n_letters"] + 20),
        np.sqrt(g["n_shout"] / (n + 5)), np.sqrt(g["n_repeat_words"] / (n + 5)), np.sqrt(g["n_adjacent"] / (n + 5)), (g["n_unique"] + 5) / (n + 5), np.log((chars + 5) / (n + 1)),
        np.sqrt(g["n_dup_lines"] / (g["n_lines"] + 2)), g["n_punct"] / (n + 5), np.sqrt(g["n_digits"] / (chars + 20)), np.log1p(n / (g["n_lines"] + 1)),
    ])


def _standard(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((features(stats) - mean) / scale, -CLIP, CLIP)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.round(_standard(stats, self.mean, self.scale) @ self.weights, PLACES)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """0 to 1; ACCEPT at the threshold."""
        z = np.clip(self.raw(stats) - self.threshold, -30, 30)
        return 1 / (1 + (1 - ACCEPT) / ACCEPT * np.exp(-z))


def _sums(rows: DataFrame, size: int, function: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``function(labels, stats)``, ``size`` numbers, over batches of all ``rows``; summed in the tasks and between them, so that the driver gets one."""
    names = ["__label", *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                label, *stats = (batch.column(batch.schema.names.index(n)).to_numpy(zero_copy_only=False) for n in names)
                total += function(label, np.column_stack(stats))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "v"])

    with narrow_batches(rows.sparkSession):
        found = rows.select(*names).mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[found["at"].to_numpy(np.int64)] = found["v"].to_numpy()
    return out


def _deposit(at: np.ndarray, size: int, columns: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.bincount(at, c, size) for c in columns], axis=1)


def _meet(weights: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """At each node of a grid, the sum over all nodes of ``weights`` times ``kernel`` at the difference of the two."""
    n = len(weights)
    return np.convolve(weights, kernel)[n - 1 : 2 * n - 1]


def _look(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, ridge: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slope and curvature at ``w`` over all pairs of a row of label 1 and a row of label 0, from one look at all rows.

    Rows are laid on a grid of scores, in shares on the two nodes beside each, as counts and sums of features; nodes then meet nodes. For the curvature they are
    laid on the nearest node of a coarser grid, with sums of products."""
    d = len(w)
    reach = CLIP * float(np.abs(w).sum())
    near, far = int(reach * GRID) + 2, int(reach * COARSE) + 2
    nodes, coarse = 2 * near + 1, 2 * far + 1
    a, b = np.triu_indices(d)
    fine_size, coarse_width = 2 * nodes * (1 + d), 1 + d + len(a)

    def lay(label: np.ndarray, stats: np.ndarray) -> np.ndarray:
        z = _standard(stats, mean, scale)
        s = z @ w
        low = np.floor(s * GRID)
        share, at = s * GRID - low, label * nodes + low.astype(np.int64) + near
        fine = _deposit(at, 2 * nodes, [1 - share, *((1 - share) * c for c in z.T)]) + _deposit(at + 1, 2 * nodes, [share, *(share * c for c in z.T)])
        rough = _deposit(label * coarse + np.rint(s * COARSE).astype(np.int64) + far, 2 * coarse, [np.ones(len(s)), *z.T, *(z[:, i] * z[:, j] for i, j in zip(a, b, strict=True))])
        return np.concatenate([fine.ravel(), rough.ravel()])

    found = _sums(rows, fine_size + 2 * coarse * coarse_width, lay)
    (worse, better), (rough_worse, rough_better) = found[:fine_size].reshape(2, nodes, 1 + d), found[fine_size:].reshape(2, coarse, coarse_width)
    pairs = worse[:, 0].sum() * better[:, 0].sum()
    lead = np.arange(1 - nodes, nodes) / GRID
    wrong = np.exp(-np.logaddexp(0, lead))
    loss = better[:, 0] @ _meet(worse[:, 0], np.logaddexp(0, -lead)) / pairs + ridge / 2 * w @ w
    slope = (worse[:, 1:].T @ _meet(better[:, 0], wrong[::-1]) - better[:, 1:].T @ _meet(worse[:, 0], wrong)) / pairs + ridge * w
    lead = np.arange(1 - coarse, coarse) / COARSE
    unsure = np.exp(-np.logaddexp(0, lead) - np.logaddexp(0, -lead))
    curve = np.zeros((d, d))
    curve[a, b] = rough_better[:, 1 + d :].T @ _meet(rough_worse[:, 0], unsure) + rough_worse[:, 1 + d :].T @ _meet(rough_better[:, 0], unsure)
    curve = curve + np.triu(curve, 1).T
    cross = rough_better[:, 1 : 1 + d].T @ np.stack([_meet(c, unsure) for c in rough_worse[:, 1 : 1 + d].T], axis=1)
    return float(loss), slope, (curve - cross - cross.T) / pairs + ridge * np.eye(d)


def _weights(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps, halved where the loss grows, until stable."""
    w, least, step = np.zeros(len(mean)), np.inf, np.zeros(len(mean))
    for _ in range(LOOKS):
        loss, slope, curve = _look(rows, mean, scale, w, ridge)
        if loss > least + 1e-5:
            step = step / 2
            w = w + step
            continue
        least, step = loss, np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-7:
            return np.round(w, PLACES)
    raise RuntimeError(f"the weights are not stable after {LOOKS} looks at all rows")


def _order_statistics(rows: DataFrame, ranker: Ranker, ranks: list[int]) -> list[float]:
    """The scores w.x of all rows that stand at ``ranks`` (from 0) in their order: exact, by counts in ever smaller buckets."""
    unit = 10**PLACES
    least = -int(CLIP * float(np.abs(ranker.weights).sum()) * unit) - unit
    width = 1
    while width * BUCKETS <= -2 * least:
        width *= BUCKETS
    lows, left = [least] * len(ranks), list(ranks)
    while True:
        starts, size = list(lows), width

        def count(label: np.ndarray, stats: np.ndarray) -> np.ndarray:
            s = np.rint(ranker.raw(stats) * unit).astype(np.int64)
            at = [(s - start) // size for start in starts]
            return np.concatenate([np.bincount(x[(x >= 0) & (x < BUCKETS)], minlength=BUCKETS) for x in at]).astype(float)

        for k, counts in enumerate(_sums(rows, BUCKETS * len(ranks), count).reshape(len(ranks), BUCKETS)):
            ends = np.cumsum(counts)
            bucket = int(np.searchsorted(ends, left[k], side="right"))
            left[k] -= int(ends[bucket] - counts[bucket])
            lows[k] += bucket * width
        if width == 1:
            return [low / unit for low in lows]
        width //= BUCKETS


def fit(rows: DataFrame, ridge: float = 1e-3) -> Ranker:
    """Bradley-Terry scores w.x from all ``rows`` (__label, and STATS), which are read many times: of a pair, P(i preferred to j) = sigmoid(w.(x_i - x_j)); logistic
    loss over all pairs of a row of label 1 and one of label 0.

    The threshold is the quantile of the rows' scores at the share of label 0. With one class alone all weights are 0."""
    d = len(features(np.zeros((1, len(STATS))))[0])
    n, n_better, *total = _sums(rows, 2 + d, lambda label, stats: np.array([len(label), label.sum(), *features(stats).sum(0)]))
    if not n:
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean = np.round(np.array(total) / n, PLACES)
    scale = np.round(np.sqrt(_sums(rows, d, lambda label, stats: ((features(stats) - mean) ** 2).sum(0)) / n), PLACES) + 1e-6
    if n_better in (0, n):
        return Ranker(mean, scale, np.zeros(d), -1.0 if n_better else 2.0)
    ranker = Ranker(mean, scale, _weights(rows, mean, scale, ridge), 0.0)
    n, n_worse = int(n), int(n - n_better)
    below, above = _order_statistics(rows, ranker, [n_worse - 1, n_worse])
    return replace(ranker, threshold=below + (above - below) * (1 - n_worse / n))


def _stat_columns(df: DataFrame, text: str) -> DataFrame:
    ddl = ", ".join(f"{s} bigint" for s in STATS)
    return map_column(df.withColumnRenamed(text, "__text"), "__text", ddl, lambda batch: {s: list(v) for s, v in zip(STATS, zip(*map(text_stats, batch), strict=True), strict=True)} if batch else {s: [] for s in STATS})


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(__label, and STATS of the whole text) of every labelled document; of rows with one id, the one of the smallest counts is taken. Kept in the shared folder.

    Up to ``broadcast_rows`` labelled ids are broadcast, so that other texts are not looked at; beyond, all are. Texts are not shuffled."""
    known = cut(voted_labels(labels, doc_id, label, allowed), 2)
    body = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__body"))
    if known.count() <= broadcast_rows:
        body = body.join(F.broadcast(known.select("__id")), "__id", "left_semi")
    counted = _stat_columns(body, "__body").groupBy("__id").agg(F.min(F.struct(*STATS)).alias("s"))
    return cut(counted.join(known.hint("merge"), "__id").select("__label", "s.*"), 2)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Ranker:
    """A ranker from every labelled document that ``allowed`` lets in."""
    return fit(training_rows(docs, labels, allowed, doc_id, text, label))


def score_documents(docs: DataFrame, ranker: Ranker, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (0 to 1) added, from whole texts. A null text scores as an empty one, equal texts score equal. A narrow map."""

    def run(batch: list[bytes | None]) -> dict[str, list]:
        return {out: ranker.score(np.array([text_stats(x) for x in batch])).tolist() if batch else []}

    docs = docs.drop(out)
    body = unused(docs, "__text")
    return map_column(docs.withColumn(body, F.col(text)), body, f"`{out}` double", run)


def filter_quality(docs: DataFrame, labels: DataFrame, allowed: Column, threshold: float = ACCEPT) -> DataFrame:
    """The rows of ``docs``, with their columns, that score ``threshold`` or more. An empty table stays empty."""
    score = unused(docs, "__score")
    scored = score_documents(docs, train(docs, labels, allowed), out=score)
    return scored.where(F.col(score) >= threshold).drop(score)
