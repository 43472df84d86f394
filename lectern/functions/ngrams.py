"""Consecutive repetitions of word n-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import ALLOWED_PUNCT


def repeats(ids: np.ndarray, max_ngram: int) -> np.ndarray:
    """By n - 1 and position: how often the n-gram there stands in a row; 0 where it does not fit.

    Positions equal to the one n further form runs; a run of length r from a position makes 1 + r // n repetitions."""
    size = len(ids)
    out = np.zeros((max_ngram, size), np.int64)
    for n in range(1, min(max_ngram, size) + 1):
        equal = np.zeros(size + 1, bool)
        equal[: size - n] = ids[:-n] == ids[n:] if n < size else False
        stops = np.flatnonzero(~equal)
        run = stops[np.searchsorted(stops, np.arange(size))] - np.arange(size)
        out[n - 1] = np.where(np.arange(size) + n <= size, 1 + run // n, 0)
    return out


def collapse(words: list[str], max_ngram: int = 6, min_count: int = 3) -> list[str]:
    """From the left, the longest n-gram that stands ``min_count`` times in a row is kept once. Words compare without edge punctuation and case."""
    if not words:
        return []
    seen: dict[str, int] = {}
    ids = np.array([seen.setdefault(w.strip(ALLOWED_PUNCT).lower(), len(seen)) for w in words])
    times = repeats(ids, max_ngram)
    enough = times >= max(min_count, 1)
    longest = np.where(enough.any(axis=0), max_ngram - enough[::-1].argmax(axis=0), 0)
    out: list[str] = []
    at = 0
    while at < len(words):
        n = int(longest[at])
        out += words[at : at + max(n, 1)]
        at += n * int(times[n - 1, at]) if n else 1
    return out


def collapse_repeated_ngrams(words: Column, max_ngram: int = 6, min_count: int = 3) -> Column:
    """collapse() over an array column, in Arrow batches: each jump depends on the last, which no built-in function expresses in linear time."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda w: None if w is None else collapse(list(w), max_ngram, min_count))

    return run(words)
