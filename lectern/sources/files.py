"""Listings, whole-file reads and per-file writes on any file system that Spark knows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = "name string, path string, is_dir boolean, is_link boolean, size bigint"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def open_system(path: str):
    """Arrow's file system for a path or URI, and the path within it. Local paths are taken as they are, blanks and all."""
    from pyarrow import fs

    if "://" not in path or path.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file://").removeprefix("file:"))
    scheme, _, rest = path.partition("://")
    authority, _, inner = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{inner}"


def require_directory(spark: SparkSession, path: str) -> None:
    place, fs = _fs(spark, path)
    if not fs.exists(place) or not fs.getFileStatus(place).isDirectory():
        raise FileNotFoundError(f"source directory not found: {path}")


def _is_link(spark: SparkSession, status) -> bool:
    uri = status.getPath().toUri()
    return status.isSymlink() or uri.getScheme() in (None, "file") and os.path.islink(uri.getPath())


def list_directory(spark: SparkSession, path: str, suffix: str = "", recursive: bool = False) -> DataFrame:
    """(name, path, is_dir, is_link, size), sorted by path components. Hidden and empty files are listed too, which Spark's own readers skip.

    The driver lists ``path`` alone; when ``recursive``, tasks list what its folders hold. ``name`` is relative to ``path``."""
    place, fs = _fs(spark, path)
    root = fs.getFileStatus(place).getPath().toString().rstrip("/") + "/"
    rows = []
    for status in fs.listStatus(place):
        full = status.getPath().toString()
        rows.append((full[len(root) :], full, status.isDirectory(), _is_link(spark, status), 0 if status.isDirectory() else status.getLen()))
    top = spark.createDataFrame(sorted((r for r in rows if recursive or r[0].endswith(suffix)), key=lambda r: r[0]), LISTING)
    if not recursive:
        return top
    folders = top.where("is_dir AND NOT is_link")
    below = folders.repartition(max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism))).mapInPandas(_below, LISTING)
    found = top.unionByName(below)
    return (found.where(F.col("name").endswith(suffix)) if suffix else found).orderBy(F.split("name", "/"))


def _below(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the folders of a listing hold, at any depth; links are listed and not followed."""
    from pyarrow import fs

    for batch in batches:
        for folder in batch.itertuples(index=False):
            system, inner = open_system(folder.path)
            local, todo = isinstance(system, fs.LocalFileSystem), [inner]
            while todo:
                rows = []
                for found in system.get_file_info(fs.FileSelector(todo.pop())):
                    is_dir, is_link = found.type == fs.FileType.Directory, local and os.path.islink(found.path)
                    if is_dir and not is_link:
                        todo.append(found.path)
                    end = found.path[len(inner) :]
                    rows.append((folder.name + end, folder.path.rstrip("/") + end, is_dir, is_link, 0 if is_dir else found.size))
                yield pd.DataFrame(rows, columns=["name", "path", "is_dir", "is_link", "size"]).astype({"is_dir": bool, "is_link": bool, "size": "int64"})


def reject_links(listing: DataFrame) -> DataFrame:
    if links := [r["name"] for r in listing.where("is_link").select("name").take(5)]:
        raise ValueError(f"symbolic links are not followed: {', '.join(links)}")
    return listing


def read_files(listing: DataFrame, batch_bytes: int = 16 << 20) -> DataFrame:
    """``listing`` with ``content``; each file is opened once, in the tasks, through Arrow's file systems. A task holds one file, or ``batch_bytes`` of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size, begin = [], 0, 0
            for k, path in enumerate(batch["path"], 1):
                system, inner = open_system(path)
                with system.open_input_stream(inner) as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= batch_bytes or k == len(batch):
                    yield batch.iloc[begin:k].assign(content=held)
                    held, size, begin = [], 0, k

    schema = T.StructType([*listing.schema, T.StructField("content", T.BinaryType())])
    files = listing.where("NOT is_dir")
    return files.repartition(max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))).mapInPandas(run, schema)


def read_texts(listing: DataFrame) -> DataFrame:
    """(name, path, text, status, error): strict UTF-8, a bad file fails alone."""
    read = read_files(listing).withColumn("ok", F.is_valid_utf8(F.col("content").cast("string")))
    return read.select("name", "path", F.when(F.col("ok"), F.col("content").cast("string")).alias("text"), F.when(F.col("ok"), "readable").otherwise("failed").alias("status"), F.when(~F.col("ok"), "not valid UTF-8").alias("error"))


def read_one(spark: SparkSession, path: str, blank_is_error: bool = False) -> str:
    place, fs = _fs(spark, path)
    if not fs.exists(place) or not fs.getFileStatus(place).isFile():
        raise ValueError(f"not a file: {path}")
    text = "".join(r.content.decode() for r in read_files(spark.createDataFrame([(place.getName(), place.toString() if "://" in path else os.path.abspath(path), False, False, 0)], LISTING)).collect())
    if blank_is_error and not text.strip():
        raise ValueError(f"blank file: {path}")
    return text


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """(rel_path, is_file, content) of everything below ``path``; links raise."""
    listing = reject_links(list_directory(spark, path, recursive=True))
    files = read_files(listing).select(F.col("name").alias("rel_path"), F.lit(True).alias("is_file"), "content")
    return files.unionByName(listing.where("is_dir").select(F.col("name").alias("rel_path"), F.lit(False).alias("is_file"), F.lit(None).cast("binary").alias("content")))


def _write(path: str, body: str) -> None:
    system, inner = open_system(path)
    system.create_dir(os.path.dirname(inner), recursive=True)
    made = f"{inner}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(made) as f:
        f.write(body.encode())
    system.move(made, inner)


def exists(path: str) -> bool:
    from pyarrow import fs

    system, inner = open_system(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def remove(spark: SparkSession, path: str) -> None:
    """A file or folder and all in it, if it is there."""
    place, fs = _fs(spark, path)
    fs.delete(place, True)


def write_file(path: str, body: str) -> None:
    """A whole new file, moved into place at once."""
    _write(path, body)


def write_files(files: DataFrame, root: str) -> None:
    """A file for each row (rel_path, body) below ``root``, which all executors share. Each is moved into place, so a repeated task does no harm."""

    def run(rows: Iterator[T.Row]) -> None:
        for r in rows:
            _write(f"{root.rstrip('/')}/{r['rel_path']}", r["body"])

    files.select("rel_path", "body").foreachPartition(run)
