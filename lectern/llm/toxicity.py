"""Toxicity by compression distance: two zstandard dictionaries, compressed lengths of windows, calibrated thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import map_column, unused
from lectern.llm.quality_classifier import training_labels

#: Labelled rows, and bytes of their texts, that the dictionaries and thresholds are fitted on at most.
SAMPLE_ROWS, SAMPLE_BYTES = 9_000, 48 << 20
#: Windows of each dictionary at most.
TOXIC_WINDOWS, PLAIN_WINDOWS = 2000, 3000
#: zstandard's optimal parsing: a window's length follows from the longest match, not from the search's luck.
LEVEL = 16
GRAM = 4
#: Precedes each window, in the dictionaries too, so that a window and its longest known beginning are one match.
MARK = bytes(range(1, 7)) + bytes(range(14, 32))
#: A longer window is in no dictionary; its own beginning is still compared with those that are.
LONGEST_WINDOW = 64
#: Distinct windows whose lengths a worker remembers.
REMEMBERED = 400_000
_WINDOW = re.compile(rb"[0-9a-z\x80-\xff]+")
ACCEPT = 0.3


def windows(text: bytes | None) -> list[bytes]:
    """A window is one word: a run of ASCII letters and digits, lower-cased, and bytes beyond ASCII."""
    return _WINDOW.findall(text.lower()) if text else []


def _grams(word: bytes) -> set[bytes]:
    return {word[i : i + GRAM] for i in range(len(word) - GRAM + 1)} or {word}


class _Lengths(dict):
    """By window: the bytes that the toxic dictionary saves over the ordinary one."""

    def __init__(self, plain: bytes, toxic: bytes) -> None:
        super().__init__()
        self.compress = []
        for content in (plain, toxic):
            known = zstandard.ZstdCompressionDict(content or MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __missing__(self, word: bytes) -> int:
        window = MARK + word + b" "
        saved = len(self.compress[0](window)) - len(self.compress[1](window))
        if len(self) < REMEMBERED:
            self[word] = saved
        return saved


@dataclass(frozen=True)
class Model:
    plain: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scorer(self):
        lengths = _Lengths(self.plain, self.toxic)

        def score(texts: list[bytes | None]) -> list[float]:
            if not texts:
                return []
            x = np.array([evidence(t, lengths) for t in texts])
            z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))]) @ self.weights
            return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()

        return score


def evidence(text: bytes | None, lengths: _Lengths) -> list[float]:
    """Of all windows of a whole text: the largest savings, and the shares of windows beyond each threshold."""
    words = windows(text)
    if not words:
        return [0.0] * 6
    saved = np.fromiter(map(lengths.__getitem__, words), np.int64, len(words))
    top = np.sort(np.partition(saved, max(0, len(saved) - 3))[-3:])[::-1].clip(0, 8)
    n = len(words) + 20
    return [float(top[0]), float(top[:2].sum()), float(top.sum()), float(np.sqrt((saved >= 3).sum() / n)), float(np.sqrt((saved >= 4).sum() / n)), float(np.sqrt((saved >= 5).sum() / n))]


class _Counts:
    """In how many texts each window and each sequence of GRAM bytes stands, by label and fold; counted once for all choices of folds."""

    def __init__(self, texts: list[bytes], label: np.ndarray, fold: np.ndarray, folds: int) -> None:
        self.words: dict[bytes, int] = {}
        names: dict[bytes, int] = {}
        grams: list[np.ndarray] = []
        side = label.astype(np.int64) * folds + fold
        at: list[list[np.ndarray]] = [[] for _ in range(2 * folds)]
        gram_at: list[list[np.ndarray]] = [[] for _ in range(2 * folds)]
        for t, s in zip(texts, side.tolist(), strict=True):
            own = set(windows(t))
            for w in sorted(w for w in own if w not in self.words):
                self.words[w] = len(self.words)
                grams.append(np.array([names.setdefault(g, len(names)) for g in _grams(w)], np.int32))
            if own:
                ids = np.array([self.words[w] for w in own], np.int32)
                at[s].append(ids)
                gram_at[s].append(np.unique(np.concatenate([grams[i] for i in ids])))
        count = lambda parts, n: np.stack([np.bincount(np.concatenate(p), minlength=n) if p else np.zeros(n, np.int64) for p in parts]).reshape(2, folds, n)
        self.by_word, self.by_gram = count(at, len(self.words)), count(gram_at, len(names))
        self.texts = np.bincount(side, minlength=2 * folds).reshape(2, folds)
        self.sizes = np.array([len(g) for g in grams], np.int64)
        self.grams = np.concatenate(grams) if grams else np.zeros(0, np.int32)

    def dictionaries(self, folds: list[int]) -> tuple[bytes, bytes]:
        """Raw dictionary contents from the texts of ``folds``, most frequent windows last (nearest). Toxic windows are those of toxic texts with a sequence of
        bytes that recurs in toxic texts at 8 times its rate in ordinary ones; ordinary windows are the most frequent of ordinary texts."""
        (plain, toxic), (g_plain, g_toxic), (n_plain, n_toxic) = (x[:, folds].sum(axis=1) for x in (self.by_word, self.by_gram, self.texts))
        n_plain, n_toxic = max(1, n_plain), max(1, n_toxic)
        telling = (g_toxic >= max(2, 0.02 * n_toxic)) & (g_toxic / n_toxic > 8 * (g_plain + 0.5) / n_plain)
        has = np.logical_or.reduceat(telling[self.grams], np.cumsum(self.sizes) - self.sizes) if len(self.sizes) else np.zeros(0, bool)
        chosen = has & (toxic > 0) & (toxic / n_toxic > 3 * plain / n_plain)
        names = list(self.words)

        def content(of: np.ndarray, n: np.ndarray, most: int) -> bytes:
            ranked = sorted(((-int(n[i]), names[i]) for i in np.flatnonzero(of)))[:most]
            return b"".join(MARK + w + b" " for _, w in reversed(ranked) if len(w) <= LONGEST_WINDOW)

        return content(~chosen & (plain > 0), plain, PLAIN_WINDOWS), content(chosen, toxic, TOXIC_WINDOWS)


def fit(texts: list[bytes], label: np.ndarray) -> Model:
    """Dictionaries from the whole sample; thresholds, as logistic weights, from the evidence that each row gives under dictionaries of the other folds."""
    y = label.astype(float)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", np.zeros(6), np.ones(6), np.array([0.0] * 6 + [3.0 if len(y) and y[0] else -3.0]))
    folds = 3 if len(texts) > 1000 else 8
    of = np.arange(len(texts)) % folds
    counts = _Counts(texts, label, of, folds)
    x = np.zeros((len(texts), 6))
    for k in range(folds):
        lengths = _Lengths(*counts.dictionaries([f for f in range(folds) if f != k]))
        x[of == k] = [evidence(texts[i], lengths) for i in np.flatnonzero(of == k)]
    plain, toxic = counts.dictionaries(list(range(folds)))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(7), 1e-3 * np.eye(7)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + ridge, z.T @ (p - y) / len(z) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(plain, toxic, mean, scale, w)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from at most SAMPLE_ROWS labelled documents of at most SAMPLE_BYTES bytes together, whole texts in order of a hash of the id; a text that does not
    fit any more is passed over, and the next ones are tried. Of rows with one id, the smallest text is taken. Without a row, or with one label alone, every
    text gets one score."""
    sample = training_labels(labels, doc_id, label, allowed, SAMPLE_ROWS)
    joined = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__body")).join(F.broadcast(sample), "__id")  # at most SAMPLE_ROWS pairs of numbers
    sizes = joined.groupBy("__id", "__label").agg(F.min(F.octet_length("__body")).alias("n")).withColumn("h", F.xxhash64("__id")).orderBy("h", "__id").collect()
    total, ids = 0, []
    for r in sizes:
        if total + r["n"] <= sample_bytes:
            total += r["n"]
            ids.append((r["__id"], r["__label"]))
    if not ids:
        return fit([], np.zeros(0, int))
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, sample.select("__id", "__label").schema))
    found = joined.drop("__label").join(chosen, "__id").groupBy("__id", "__label").agg(F.min_by("__body", F.struct(F.octet_length("__body"), F.xxhash64("__body"))).alias("body"))
    rows = found.orderBy(F.xxhash64("__id"), "__id").collect()
    return fit([r["body"].encode() for r in rows], np.array([r["__label"] for r in rows]))


def score_documents(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (0 to 1) added, from the windows of whole texts. A null text scores as an empty one. A narrow map."""
    held: dict[str, object] = {}

    def run(batch: list[bytes | None]) -> dict[str, list]:
        if "score" not in held:
            held["score"] = model.scorer()
        return {out: held["score"](batch)}

    docs = docs.drop(out)
    body = unused(docs, "__text")
    return map_column(docs.withColumn(body, F.col(text)), body, f"`{out}` double", run)
