"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of one Arrow batch; texts are long, so Spark's default of 10,000 rows would not bound a worker's memory.
BATCH_ROWS = 500
#: Bytes of one Arrow batch.
BATCH_BYTES = 16 << 20


#: Narrow rows of one key that a task takes without harm.
TASK_ROWS = 100_000
#: Rows of a few numbers that are broadcast at most.
BROADCAST_ROWS = 500_000
#: A key with more than one row in so many is hot; there are fewer of them than this, however large the table.
HOT = 10_000
#: Seconds after which release() no longer waits until the JVM knows what Python let go of.
TOLD_S = 30


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only where it is unset and all runs on this machine."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lectern-"))
    return context._jsc.sc().getCheckpointDir().get()


def meet(rows: DataFrame, known: DataFrame, key: str, task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """The rows of ``rows`` whose ``key`` stands in ``known``, with the columns of ``known`` but ``uses``. No key's rows are one task's work.

    ``known``: narrow rows, one for each key, already cut(); ``uses``: how many rows have the key. Keys of more than ``task_rows`` rows and more than 1 in
    ``hot`` of all uses, which are fewer than ``hot``, are broadcast. The others meet in a shuffled hash join, where the smaller side is built."""
    plain, often = known.drop("uses"), _often(known, key, task_rows, hot)
    if not often:
        return rows.join(plain.hint("shuffle_hash"), key)
    is_hot = F.col(key).isin(often)
    return rows.where(is_hot).join(F.broadcast(plain.where(is_hot)), key).unionByName(rows.where(~is_hot).join(plain.where(~is_hot).hint("shuffle_hash"), key))


def unmet(rows: DataFrame, known: DataFrame, key: str, task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """The other rows of ``rows``, with their own columns."""
    often = _often(known, key, task_rows, hot)
    rest, keys = rows, known.select(key)
    if often:
        rest, keys = rows.where(F.coalesce(~F.col(key).isin(often), F.lit(True))), keys.where(~F.col(key).isin(often))
    return rest.join(keys.hint("shuffle_hash"), key, "left_anti")


def _often(known: DataFrame, key: str, task_rows: int, hot: int) -> list:
    """The hot keys: fewer than ``hot``."""
    total, most = known.agg(F.sum("uses"), F.max("uses")).first()
    limit = max(task_rows, (total or 0) / hot)
    return [r[0] for r in known.where(F.col("uses") > limit).select(key).collect()] if (most or 0) > limit else []


def cut(df: DataFrame, tasks_a_core: int | None = None) -> DataFrame:
    """``df`` computed once and kept in the shared folder, with its lineage cut. For narrow rows.

    ``tasks_a_core``: at most so many files for each core, for results far smaller than their input, which else would be many tiny files."""
    spark = df.sparkSession
    shared_dir(spark)
    return (df.coalesce(tasks_a_core * spark.sparkContext.defaultParallelism) if tasks_a_core else df).checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffles and checkpoints that no plan refers to any more; it does so only when the driver collects its garbage.

    py4j tells the JVM what Python let go of from a thread that, once idle, looks again a second later; a collection before that would free nothing of it.
    What the first collection lets go of, as the last job's stages, the second finds."""
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())  # without that thread the JVM is told at once
    for _ in range(2):
        gc.collect()
        until = time.monotonic() + TOLD_S
        while waiting and time.monotonic() < until:
            time.sleep(0.05)
        time.sleep(0.1)  # the last one is on its way
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes that a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def narrow_batches(spark: SparkSession, rows: int = 20_000) -> Iterator[None]:
    """Larger Arrow batches while rows of a few numbers are worked on within the block; what is built before and run later keeps its bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or if the caller has such a column, ``name`` with underscores that none of its columns has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_column(df: DataFrame, column: str, schema: str, function: Callable[[list[bytes | None]], dict[str, list]]) -> DataFrame:
    """``df`` with the columns of ``schema`` added and ``column`` taken away.

    ``function`` gets the UTF-8 bytes of ``column`` for one Arrow batch and returns a list for each new column."""
    bounded_batches(df.sparkSession)
    keep = [c for c in df.columns if c != column]
    out = StructType.fromDDL(schema)
    types = [(f.name, _arrow(f.dataType.simpleString())) for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index(column)
            made = function(batch.column(at).cast(pa.binary()).to_pylist())
            arrays = [batch.column(i) for i in range(len(names)) if i != at]
            arrays += [pa.array(made[n], kind) for n, kind in types]
            yield pa.RecordBatch.from_arrays(arrays, names=[n for n in names if n != column] + [n for n, _ in types])

    return df.select(*keep, column).mapInArrow(run, StructType([df.schema[c] for c in keep] + list(out)))


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}[kind]


SYMBOLS = b"#*$%&|<>"
_SYMBOLS = np.frombuffer(SYMBOLS, np.uint8)
_SPACES = np.array([9, 10, 11, 12, 13, 32])
#: The fields of text_stats() in order.
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_unique", "n_lines", "n_adjacent", "n_punct", "n_shout", "n_digits")


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """Counts over one whole text: words are runs of bytes other than ASCII white space.

    A null text counts as an empty one. ``n_repeat_words`` are words in 5-word windows that occur twice or more."""
    if not text:
        return (0,) * len(STATS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n = len(words)
    chars = int(len(text) - counts[128:192].sum() - counts[_SPACES].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    upper = int(counts[65:91].sum())
    repeat = adjacent = 0
    if n > 1:
        at = np.fromiter(map(ids.__getitem__, words), np.int64, n)
        adjacent = int((at[1:] == at[:-1]).sum())
        if n > 5 and len(ids) < n:
            repeat = repeated_words(at, len(ids))
    return (
        n, chars, int(counts[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeat, upper, upper + int(counts[97:123].sum()),
        len(ids), len(lines), adjacent, int(counts[[33, 44, 46, 58, 59, 63]].sum()), int(counts[33]), int(counts[48:58].sum()),
    )


def repeated_words(ids: np.ndarray, n_ids: int, width: int = 5) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    windows = len(ids) - width + 1
    code, size = ids[:windows], n_ids
    for k in range(1, width):
        if size * n_ids >= 1 << 62:
            distinct, code = np.unique(code, return_inverse=True)
            size = len(distinct)
        code = code * n_ids + ids[k : k + windows]
        size *= n_ids
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(windows, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())
